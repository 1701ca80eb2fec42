"""Column names, types and labels of the occurrence tables. All of these are fixed values."""

from __future__ import annotations

RAW_COLUMNS = ["gbifID", "taxonKey", "scientificName", "decimalLatitude", "decimalLongitude", "countryCode", "basisOfRecord", "coordinateUncertaintyInMeters", "year", "month", "eventDate"]
OCCURRENCE = "gbifID long, taxonKey long, scientificName string, decimalLatitude double, decimalLongitude double, countryCode string, basisOfRecord string, coordinateUncertaintyInMeters double, year long, month long, eventDate string"
NUMERIC_COLUMNS = ["gbifID", "taxonKey", "decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters", "year", "month"]
INTEGER_COLUMNS = ["gbifID", "taxonKey", "year", "month"]
REQUIRED_RAW = ["gbifID", "scientificName", "taxonKey", "decimalLatitude", "decimalLongitude"]
REQUIRED_TYPED = ["gbifID", "taxonKey", "decimalLatitude", "decimalLongitude"]
ALLOWED_BASIS = ["HUMAN_OBSERVATION", "MACHINE_OBSERVATION", "PRESERVED_SPECIMEN"]
SITE_COLUMNS = ["SITECODE", "SITENAME", "MS", "SITETYPE"]

CERTAINLY_INSIDE = "Certainly Inside"
INSIDE_UNCERTAIN = "Inside – Positional Uncertainty"
OUTSIDE_UNCERTAIN = "Outside – Positional Uncertainty"
CERTAINLY_OUTSIDE = "Certainly Outside"
UNCLASSIFIED = "Unclassified"
WITHIN_LABEL = "Baseline within (point-in-polygon)"
OUTSIDE_LABEL = "Baseline outside (point-in-polygon)"

LISA_LABELS = ["HH", "LL", "HL", "LH", "Not significant"]

# Text that pandas reads as missing by default.
NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

EUROPE = {"min_lon": -35.0, "max_lon": 45.0, "min_lat": 24.0, "max_lat": 75.0}

COLUMN_ROLES = {
    "gbifID": "primary key",
    "taxonKey": "taxonomic identifier",
    "scientificName": "taxonomic label",
    "basisOfRecord": "record provenance field",
    "eventDate": "raw temporal field",
    "year": "derived temporal field",
    "month": "derived temporal field",
    "countryCode": "geographic code",
    "decimalLatitude": "spatial coordinate",
    "decimalLongitude": "spatial coordinate",
    "coordinateUncertaintyInMeters": "spatial precision field",
}
LOGICAL_TYPES = {
    "gbifID": "integer identifier",
    "taxonKey": "integer identifier",
    "eventDate": "date-like string",
    "year": "temporal integer",
    "month": "temporal integer",
    "decimalLatitude": "numeric measurement",
    "decimalLongitude": "numeric measurement",
    "coordinateUncertaintyInMeters": "numeric measurement",
    "basisOfRecord": "categorical-like string",
    "countryCode": "categorical-like string",
    "scientificName": "free-text taxonomic field",
}
MEASURED = ["decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters", "year", "month"]
DATE_LIKE = ["eventDate"]
