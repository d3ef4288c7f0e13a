"""XML walked element by element, for what nests without bound and keeps its order."""

from __future__ import annotations

import json
import sys
from collections.abc import Callable
from xml.parsers import expat

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The geometries of a placemark that have a GeoJSON form, and those that have none.
SHAPES = ("Point", "LineString", "LinearRing", "Polygon", "MultiGeometry")
NO_SHAPES = ("Model", "Track", "MultiTrack")

# Namespaces of text documents, and what stands inside a paragraph without being its text.
TEXT_NS, OFFICE_NS = "urn:oasis:names:tc:opendocument:xmlns:text:1.0", "urn:oasis:names:tc:opendocument:xmlns:office:1.0"
DRAW_NS = "urn:oasis:names:tc:opendocument:xmlns:drawing:1.0"
ASIDE = {f"{TEXT_NS} note-citation", f"{TEXT_NS} ruby-text", f"{OFFICE_NS} annotation"}


def element_tree(text: str) -> tuple[str, list, list[str]]:
    """An element as ``(name without prefix, children, texts)``; prefixes need not be declared."""
    top: list = []
    stack = [("", top, [])]

    def start(name: str, _: dict) -> None:
        node = (name.rsplit(":", 1)[-1], [], [])
        stack[-1][1].append(node)
        stack.append(node)

    parser = expat.ParserCreate()
    parser.StartElementHandler = start
    parser.EndElementHandler = lambda _: stack.pop()
    parser.CharacterDataHandler = lambda data: stack[-1][2].append(data)
    parser.Parse(text, True)
    return top[0]


def below(node: tuple, *names: str) -> list[tuple]:
    """The elements a path of names leads to."""
    found = [node]
    for name in names:
        found = [child for parent in found for child in parent[1] if child[0] == name]
    return found


def positions(node: tuple) -> list[list[float | None]]:
    """The ``lon,lat[,alt]`` tuples of an element; a part that is no number is null."""

    def number(text: str) -> float | None:
        try:
            return float(text)
        except ValueError:
            return None

    texts = "".join(data for found in below(node, "coordinates") for data in found[2])
    return [[number(part) for part in place.split(",")] for place in texts.split()]


def shape(node: tuple) -> dict:
    """The GeoJSON object of a geometry element, collections nested as deep as they are.

    A collection of points, lines or polygons alone is a multi-geometry of their kind.
    """
    kind = node[0]
    if kind == "Point":
        return {"type": kind, "coordinates": (positions(node) or [None])[0]}
    if kind in ("LineString", "LinearRing"):
        return {"type": "LineString", "coordinates": positions(node)}
    if kind == "Polygon":
        rings = below(node, "outerBoundaryIs", "LinearRing") + below(node, "innerBoundaryIs", "LinearRing")
        return {"type": kind, "coordinates": [positions(ring) for ring in rings]}
    parts = [shape(child) for child in node[1] if is_shape(child)]
    kinds = {part["type"] for part in parts}
    if len(kinds) == 1 and (one := kinds.pop()) in ("Point", "LineString", "Polygon"):
        return {"type": f"Multi{one}", "coordinates": [part["coordinates"] for part in parts]}
    return {"type": "GeometryCollection", "geometries": parts}


def is_shape(node: tuple) -> bool:
    if node[0] in NO_SHAPES:
        raise ValueError(f"a {node[0]} has no GeoJSON form")
    return node[0] in SHAPES


def placemark_shape(text: str | None) -> str | None:
    """GeoJSON text of a placemark's geometry, null where it has none."""
    if text is None:
        return None
    found = [child for child in element_tree(text)[1] if is_shape(child)]
    return json.dumps(shape(found[0]), separators=(",", ":")) if found else None


def document_paragraphs(text: str | None, own_text_only: bool) -> list[str] | None:
    """The text of each paragraph of a text document, in the order they begin, blank ones too."""
    if text is None:
        return None
    done: list[list[str]] = []
    # Open elements: the number of the paragraph their text belongs to, or none.
    owner: list[int | None] = [None]

    def write(data: str) -> None:
        if owner[-1] is not None:
            done[owner[-1]].append(data)

    def start(name: str, attributes: dict) -> None:
        namespace, _, local = name.rpartition(" ")
        if name == f"{TEXT_NS} p":
            done.append([])
            owner.append(len(done) - 1)
            return
        if namespace == TEXT_NS and not own_text_only:
            if local == "s":
                write(" " * int(attributes.get(f"{TEXT_NS} c", 1)))
            elif local in ("tab", "line-break"):
                write("\t" if local == "tab" else "\n")
        aside = own_text_only or name in ASIDE or namespace == DRAW_NS
        owner.append(None if aside else owner[-1])

    parser = expat.ParserCreate(namespace_separator=" ")
    parser.StartElementHandler = start
    parser.EndElementHandler = lambda _: owner.pop()
    parser.CharacterDataHandler = write
    parser.Parse(text, True)
    return ["".join(data) for data in done]


def _mapped(fn: Callable, kind: str) -> Callable[[Column], Column]:
    def over(texts: pd.Series) -> pd.Series:
        return texts.map(fn)

    over.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(over, kind)


def placemark_geometry(text: Column) -> Column:
    """The geometry of placemarks given as XML, as GeoJSON text."""
    return _mapped(placemark_shape, "string")(text)


def paragraph_texts(xml: Column, own_text_only: bool = False) -> Column:
    """The paragraphs of text documents given as XML, as arrays of texts."""
    return _mapped(lambda text: document_paragraphs(text, own_text_only), "array<string>")(xml)
