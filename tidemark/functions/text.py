"""Column functions that clean codes, identifiers and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import fixed

WHITESPACE = " \t\n\r\x0b\x0c"
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def strip(c: Column) -> Column:
    """Remove all leading and trailing whitespace (``trim`` drops blanks only).

    Values that start and end with a visible character, nearly all of them, are passed
    on after looking at two characters.
    """
    clean = (F.ascii(c) > 32) & (F.ascii(F.right(c, F.lit(1))) > 32)
    return F.when(clean, c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def normalize_value(c: Column) -> Column:
    """Text of a raw cell; NULL, NaN, ``nan``, ``none`` and ``null`` become ``''``."""
    s = strip(c.cast("string"))
    blank = (F.octet_length(s) < 5) & F.lower(s).isin("nan", "none", "null")
    return F.when(c.isNull() | blank, F.lit("")).otherwise(s)


def lenient_number(c: Column) -> Column:
    """Blank counts as 0, a number is parsed, anything else is NULL."""
    s = strip(c.cast("string"))
    return (
        F.when(s.isNull() | (s == ""), F.lit(0.0))
        .when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))
        .otherwise(F.lit(None).cast("double"))
    )


def lenient_value(c: Column) -> Column:
    """``struct(number, text)``: the parsed number, or the text that is not one."""
    number = lenient_number(c)
    return F.struct(
        number.alias("number"),
        F.when(number.isNull(), strip(c.cast("string"))).alias("text"),
    )


def occ_class(occtype: Column) -> Column:
    """Occupancy class: text before the first dash, upper-cased."""
    return F.upper(F.split_part(occtype, F.lit("-"), F.lit(1)))


def foundation_code(found_type: Column) -> Column:
    """Foundation word or code to 7, 5, 4 or 2; anything else counts as slab."""
    word = F.upper(F.trim(found_type))
    return (
        F.when(word.isin(fixed.CRAWL_WORDS), F.lit(fixed.CRAWL_CODE))
        .when(word.isin(fixed.BASEMENT_WORDS), F.lit(fixed.BASEMENT_CODE))
        .when(word.isin(fixed.PIER_WORDS), F.lit(fixed.PIER_CODE))
        .otherwise(F.lit(fixed.SLAB_CODE))
    )


def zero_fill(c: Column, width: int) -> Column:
    """Left-pad with zeros. Longer values stay whole, unlike plain ``lpad``."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def block_fips(c: Column, missing: str = "null") -> Column:
    """15-digit census block code: digits only, zero-filled.

    ``missing="null"`` keeps NULL; ``missing="zeros"`` turns it into 15 zeros.
    """
    digits = zero_fill(F.regexp_replace(c, "[^0-9]", ""), 15)
    if missing == "null":
        return digits
    if missing == "zeros":
        return F.coalesce(digits, F.lit("0" * 15))
    raise ValueError("missing must be 'null' or 'zeros'")


def geoid(block: Column, level: str, missing: str = "null") -> Column:
    """Tract, county or state code of a census block.

    ``missing="nan_text"`` gives unmatched rows the all-zero code that results from
    padding the text ``nan``; the default keeps them in a NULL group.
    """
    width = {"tract": 11, "county": 5, "state": 2}[level]
    if missing == "nan_text":
        block = zero_fill(F.coalesce(block, F.lit("nan")), 15)
    elif missing != "null":
        raise ValueError("missing must be 'null' or 'nan_text'")
    return F.substring(block, 1, width)


def flood_class(c: Column) -> Column:
    """Canonical flood class; unknown spellings pass through trimmed."""
    s = strip(c)
    key = F.lower(s)
    out = F.coalesce(s, F.lit(""))
    by_code: dict[str, list[str]] = {}
    for spelling, code in fixed.FLOOD_CLASS_SPELLINGS.items():
        by_code.setdefault(code, []).append(spelling)
    for code, spellings in by_code.items():
        out = F.when(key.isin(spellings), F.lit(code)).otherwise(out)
    return out


def state_token(c: Column) -> Column:
    """Lookup token of a state given as FIPS, abbreviation or name."""
    s = strip(c)
    words = F.lower(F.trim(F.regexp_replace(F.translate(s, "_-", "  "), r"\s+", " ")))
    return F.when(s.rlike("^[0-9]{2}$"), s).when(s.rlike("^[A-Za-z]{2}$"), F.upper(s)).otherwise(words)


def state_partition(c: Column) -> Column:
    """Partition directory name of a state: Title_Case joined by underscores."""
    return F.replace(F.initcap(F.replace(strip(c), F.lit("_"), F.lit(" "))), F.lit(" "), F.lit("_"))


STORM_ID_PATTERN = r"^([A-Z]{2})([0-9]{1,2})([0-9]{2,4})?$"


def storm_id(c: Column, year: Column) -> Column:
    """Basin, two-digit number and four-digit year; ``year`` fills a missing one."""
    s = F.upper(c)
    given = F.regexp_extract(s, STORM_ID_PATTERN, 3)
    full_year = (
        F.when(given == "", year.cast("string"))
        .when(F.length(given) == 4, given)
        .otherwise(F.concat(F.lit("20"), given))
    )
    number = F.lpad(F.regexp_extract(s, STORM_ID_PATTERN, 2), 2, "0")
    return F.when(
        s.rlike(STORM_ID_PATTERN),
        F.concat(F.regexp_extract(s, STORM_ID_PATTERN, 1), number, full_year),
    ).otherwise(F.concat(s, year.cast("string")))


def storm_id_variants(normalized: Column, year: Column) -> Column:
    """Short form (two-digit year) first, then the full form."""
    y = year.cast("string")
    compact = F.concat(F.substring(normalized, 1, 4), F.right(y, F.lit(2)))
    return F.array_distinct(F.array(compact, normalized))


def advisory_variants(advisory: Column) -> Column:
    """Advisory number as is and zero-filled to three digits."""
    plain = advisory.cast("int").cast("string")
    return F.array_distinct(F.array(plain, zero_fill(plain, 3)))


def archive_names(normalized: Column, advisory: Column, year: Column) -> Column:
    """Ordered ``array<struct<name, tier>>``; tier 0 names the advisory, tier 1 the latest."""
    ids = storm_id_variants(normalized, year)
    advs = advisory_variants(advisory)
    exact = F.flatten(
        F.transform(
            ids,
            lambda i: F.transform(
                advs,
                lambda a: F.struct(
                    F.concat(i, F.lit("_"), a, F.lit("_tidalmask.zip")).alias("name"),
                    F.lit(0).alias("tier"),
                ),
            ),
        )
    )
    latest = F.transform(
        ids,
        lambda i: F.struct(
            F.concat(i, F.lit("_tidalmask_latest.zip")).alias("name"), F.lit(1).alias("tier")
        ),
    )
    return F.array_distinct(F.concat(exact, latest))


RASTER_NAME_PATTERN = r"^(.+)_([0-9]{4})_adv([0-9]+)_e10_"


def raster_event(name: Column) -> Column:
    """``EVENT_YEAR`` of a raster file name, NULL when the name does not follow the form."""
    return F.when(
        name.rlike(RASTER_NAME_PATTERN),
        F.concat_ws(
            "_",
            F.regexp_extract(name, RASTER_NAME_PATTERN, 1),
            F.regexp_extract(name, RASTER_NAME_PATTERN, 2),
        ),
    )


def raster_advisory(name: Column) -> Column:
    """Advisory number of a raster file name."""
    return F.regexp_extract(name, RASTER_NAME_PATTERN, 3).try_cast("int")


def raster_name(storm_name: Column, year: Column, advisory: Column) -> Column:
    """Raster file name of a storm, year and advisory."""
    return F.concat(
        F.upper(storm_name),
        F.lit("_"),
        year.cast("string"),
        F.lit("_adv"),
        advisory.cast("int").cast("string"),
        F.lit("_e10_ResultMaskRaster.tif"),
    )


def range_pct(c: Column, numeric: bool = False) -> Column:
    """First number of a text such as ``0.11 - 0.34``; above 1 it is read as percent.

    A numeric cell (``numeric``) is a value already and passes unchanged.
    """
    if numeric:
        return c.cast("double")
    first = F.regexp_extract(c, r"([0-9.]+)", 1).try_cast("double")
    return F.when(first > 1.0, first / 100.0).otherwise(first)
