"""The format dictionary: which extensions are known and how they are filed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terralode.session import local_rows

# Extension dictionary (category, extension, type, description).
FORMATS = [
    ("tabular", "csv", "tableau", "Comma-Separated Values, texte séparé par des virgules"),
    ("tabular", "tsv", "tableau", "Tab-Separated Values, texte séparé par des tabulations"),
    ("tabular", "xls", "tableau", "Fichier Excel ancien format"),
    ("tabular", "xlsx", "tableau", "Fichier Excel moderne"),
    ("tabular", "ods", "tableau", "OpenDocument Spreadsheet, tableur open-source"),
    ("tabular", "txt", "texte", "Texte brut"),
    ("tabular", "dbf", "tableau", "Ancien format de base/tabulaire dBase"),
    ("tabular", "parquet", "tableau", "Fichier colonne optimisé pour le Big Data"),
    ("tabular", "pq", "tableau", "Alias pour Parquet"),
    ("geospatial_vector", "shp", "vecteur", "Shapefile, format géographique vecteur"),
    ("geospatial_vector", "shz", "vecteur", "Shapefile compressé"),
    ("geospatial_vector", "geojson", "vecteur", "Format JSON pour données géographiques"),
    ("geospatial_vector", "kml", "vecteur", "Keyhole Markup Language, Google Earth"),
    ("geospatial_vector", "kmz", "vecteur", "Version compressée du KML"),
    ("geospatial_vector", "gpkg", "vecteur", "GeoPackage, format vecteur moderne"),
    ("geospatial_vector", "dwg", "vecteur", "Format DAO/CAO"),
    ("geospatial_vector", "dxf", "vecteur", "Format DAO/CAO"),
    ("geospatial_raster", "tiff", "raster", "GeoTIFF, image géospatiale"),
    ("geospatial_raster", "tif", "raster", "Alias de TIFF"),
    ("geospatial_raster", "jp2", "raster", "JPEG2000 pour images géospatiales"),
    ("geospatial_raster", "ecw", "raster", "Format compressé pour images géospatiales"),
    ("databases", "sql", "base", "Script SQL / dump de base de données"),
    ("databases", "db", "base", "Base SQLite ou autre base légère"),
    ("archives", "zip", "archive", "Archive compressée"),
    ("archives", "tar", "archive", "Archive Unix"),
    ("archives", "tgz", "archive", "Archive tar compressée gzip"),
    ("archives", "gz", "archive", "Gzip"),
    ("archives", "xz", "archive", "Compression XZ"),
    ("archives", "7z", "archive", "7-Zip"),
    ("archives", "bz2", "archive", "Bzip2"),
    ("archives", "rar", "archive", "RAR"),
    ("others", "json", "structuré", "Données structurées en JSON"),
    ("others", "xml", "structuré", "Données hiérarchiques en XML"),
    ("others", "pdf", "document", "Document PDF, souvent non tabulaire"),
    ("others", "docx", "document", "Document Word"),
    ("others", "odt", "document", "OpenDocument Text, document open-source"),
]

# Label of a file whose extension is not in the dictionary.
UNKNOWN = ("unknown", "inconnu", "Format non reconnu")

# The buckets files are routed to.
ROUTES = [
    "tabular",
    "geospatial_vector",
    "geospatial_raster",
    "databases",
    "archives",
    "documents",
    "others",
]

# Filed under "others" above, yet read by the document readers.
DOCUMENT_EXTENSIONS = ("pdf", "docx", "odt")


def formats_table(spark: SparkSession) -> DataFrame:
    """The dictionary as a lookup table of fixed, tiny size."""
    return local_rows(spark, FORMATS, "category string, ext string, type string, description string")
