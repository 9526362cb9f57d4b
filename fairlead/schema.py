"""The sheet: its columns, the value/[ref] pairs and the groups that rules use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The named columns of the sheet, in sheet order.
SHEET_COLUMNS = [
    "row_id", "imo_number", "imo_number_ref", "vessel_name", "vessel_name_ref", "notes", "other_names", "other_names_ref",
    "hull_number", "hull_number_ref", "status", "researcher", "last_updated", "status_ref", "shipowner", "shipowner_ref",
    "shipowner_country_area", "shipowner_country_area_ref", "shipbuilder", "shipbuilder_ref",
    "shipbuilder_yard_country_area", "shipbuilder_yard_country_area_ref", "yard_location_latitude",
    "yard_location_longitude", "yard_location_plus_code", "yard_location_accuracy", "yard_location_lat_lon_ref",
    "capacity", "capacity_units", "capacity_ref", "cargo_type", "cargo_type_ref", "vessel_type", "vessel_type_ref",
    "propulsion_type", "propulsion_type_ref", "delivery_year", "delivery_year_ref", "original_source",
    "operator_charterer", "operator_charterer_ref", "contract_date", "contract_date_ref", "price", "price_currency",
    "price_ref",
]

#: The four coordinate columns share one reference column.
COORDINATES = ["yard_location_latitude", "yard_location_longitude", "yard_location_plus_code", "yard_location_accuracy"]
COORDINATES_REF = "yard_location_lat_lon_ref"

REF_COLUMNS = [c for c in SHEET_COLUMNS if c.endswith("_ref")]
VALUE_COLUMNS = [c for c in SHEET_COLUMNS if not c.endswith("_ref")]
#: value column -> its reference column, for columns that have one of their own
REF_OF = {c: f"{c}_ref" for c in VALUE_COLUMNS if f"{c}_ref" in REF_COLUMNS}
YARD_BLOCK = ["shipbuilder_yard_country_area", "shipbuilder_yard_country_area_ref", *COORDINATES, COORDINATES_REF]

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings apply_rows apply_rows_raw "
    "giignl_fsru_fleet shipowner_facts shipbuilder_facts decisions apply_accepted verify_report verify_rerun vocab "
    "eval_items pack_sizes"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def require(df: DataFrame, *columns: str) -> DataFrame:
    """df with just these columns; a missing one is named in the error. Extra and clashing columns fall away here."""
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"missing columns {lacking}; there are {df.columns}")
    return df.select(*[F.col(f"`{c}`") for c in columns])
