"""Explicit schemas. No reader in this package infers types."""

from __future__ import annotations

from pyspark.sql import types as T

from tidemark.functions import fixed

_TYPES = {"s": T.StringType(), "l": T.LongType(), "d": T.DoubleType(), "t": T.TimestampType()}


def _struct(spec: str) -> T.StructType:
    fields = [f.split(":") for f in spec.split()]
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


# The 32 inventory fields, in order.
INVENTORY = _struct(
    "bid:s bldgtype:s cbfips:s fd_id:l firmzone:s found_ht:d found_type:s ftprntid:s ftprntsrc:s "
    "ground_elv:d ground_elv_m:d med_yr_blt:l num_story:l o65disable:d occtype:s pop2amo65:l "
    "pop2amu65:l pop2pmo65:l pop2pmu65:l source:s sqft:d st_damcat:s students:l u65disable:d "
    "val_cont:d val_struct:d val_vehic:l x:d y:d longitude:d latitude:d processed_at:t"
)

INVENTORY_WITH_STATE = T.StructType(INVENTORY.fields + [T.StructField("state", T.StringType(), True)])

# What one feature carries besides its geometry: everything that is not derived from it.
FEATURE_PROPERTIES = T.StructType(
    [f for f in INVENTORY.fields if f.name not in ("x", "y", "longitude", "latitude", "processed_at")]
)

FEATURE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField(
            "geometry",
            T.StructType(
                [
                    T.StructField("type", T.StringType()),
                    T.StructField("coordinates", T.ArrayType(T.DoubleType())),
                ]
            ),
        ),
        T.StructField("properties", FEATURE_PROPERTIES),
    ]
)

RASTER_META = T.StructType(
    [
        T.StructField("raster_id", T.StringType()),
        T.StructField("x0", T.DoubleType()),
        T.StructField("y0", T.DoubleType()),
        T.StructField("pixel_width", T.DoubleType()),
        T.StructField("pixel_height", T.DoubleType()),
        T.StructField("n_cols", T.IntegerType()),
        T.StructField("n_rows", T.IntegerType()),
        T.StructField("nodata", T.DoubleType()),
        T.StructField("projected", T.BooleanType()),
        T.StructField("zone", T.IntegerType()),
        T.StructField("south", T.BooleanType()),
    ]
)

RASTER_PIXELS = T.StructType(
    [
        T.StructField("raster_id", T.StringType()),
        T.StructField("r", T.IntegerType()),
        T.StructField("c", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
    ]
)

_CURVE_POINTS = " ".join(f"{c}:d" for c in fixed.CURVE_COLUMNS)
DEFAULT_CURVE_CSV = _struct(
    f"Occupancy:s SpecificOccupId:s Source:s Description:s Stories:s Comment:s {_CURVE_POINTS} "
    "DDF_ID:s Basement:s HazardRiverine:s HazardCV:s HazardCA:s SortOrder:s"
)
DEBRIS_CSV = _struct("DebrisID:s Description:s Finishes:d Structure:d Foundation:d Comment:s")
RESTORATION_CSV = _struct(
    "Occupancy:s Min_Depth:d Max_Depth:d RestFnID:s Min_Restor_Days:l Max_Restor_Days:l"
)
SALES_CSV = _struct("OccupancyPlaceholder:s AnnualSalesPerSqFt:d BusinessInvPctofSales:d Occupancy:s")

GROUND_TRUTH_CSV = _struct(
    "event:s event_key:s landfall_date:s county:s county_name_norm:s state_abbr:s county_fips5:s "
    "planned_shelter_population:d actual_shelter_population:d estimated_population_impacted:d"
)

VALIDATION_CSV = _struct(
    "event:s county_fips5:s county_name:s state:s census_pop:d pop_affected_low:d "
    "pop_affected_medium:d pop_affected_high:d pop_impacted_low:d pop_impacted_medium:d "
    "pop_impacted_high:d hh_shelter_low:l hh_shelter_medium:l hh_shelter_high:l hh_feeding_low:l "
    "hh_feeding_medium:l hh_feeding_high:l shelter_pop:d planned_shelter:d actual_shelter:d "
    "gt_county_name:s gt_state_name:s total_shelter_est:l"
)

SVI = T.StructType(
    [
        T.StructField(c, T.StringType() if c in ("ST_ABBR", "COUNTY", "FIPS") else T.DoubleType())
        for c in fixed.SVI_COLUMNS
    ]
)
