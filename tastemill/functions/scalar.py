"""Column expressions: time, rounding, text, buckets, hashing. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86400


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- rounding ---------------------------------------------------------------

def half_even(x: Column | str, decimals: int = 3) -> Column:
    """Round to ``decimals`` places, halves to the even digit."""
    scale = float(10**decimals)
    return F.rint(col(x) * F.lit(scale)) / F.lit(scale)


def tidy(x: Column | str, decimals: int = 6) -> Column:
    """Fixed number of decimals for results, so that the order of a sum cannot show.

    ``rint`` stays in primitive doubles; ``F.round`` would build a BigDecimal per row.
    """
    return half_even(x, decimals)


def safe_ratio(num: Column, den: Column) -> Column:
    """num/den as double; null when the denominator is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


# --- time -------------------------------------------------------------------

def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a timestamp column."""
    return F.unix_timestamp(col(ts))


def parse_epoch(text: Column | str, pattern: str = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") -> Column:
    """Timestamp text to epoch seconds; text that does not parse gives null."""
    return F.unix_timestamp(F.try_to_timestamp(col(text), F.lit(pattern)))


def time_closeness(t1: Column, t2: Column) -> Column:
    """1/(1 + days between); a missing time counts as 0 (G1)."""
    gap = F.abs(F.coalesce(t1, F.lit(0)) - F.coalesce(t2, F.lit(0)))
    return F.lit(1.0) / (F.lit(1.0) + gap / F.lit(float(DAY_SECONDS)))


def recency(latest: Column, ts: Column, decimals: int | None = 3) -> Column:
    """1/(1 + age in days / 100), rounded half-even unless ``decimals`` is None."""
    age = (latest - ts) / F.lit(float(DAY_SECONDS)) / F.lit(100.0)
    value = F.lit(1.0) / (F.lit(1.0) + age)
    return value if decimals is None else half_even(value, decimals)


def activity_damping(n: Column) -> Column:
    """1/log10(1+n): a very active user or item counts for less."""
    return F.lit(1.0) / F.log10(F.lit(1.0) + n)


# --- numbers ----------------------------------------------------------------

def guarded_log1p(x: Column) -> Column:
    """ln(1+x), and -1 where x <= -1."""
    return F.when(x > -1, F.log1p(x)).otherwise(F.lit(-1.0))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def bucket_index(x: Column, bounds: Sequence[float]) -> Column:
    """Number of boundaries that are <= x: 0 below the first one."""
    edges = F.array(*[F.lit(float(b)) for b in bounds])
    return F.size(F.filter(edges, lambda b: b <= x.cast("double")))


def coerce_int(x: Column | str, default: int | None = 0) -> Column:
    """Number or text to integer; what does not parse becomes ``default``."""
    value = col(x).try_cast("double").try_cast("long")
    return value if default is None else F.coalesce(value, F.lit(default))


def coerce_double(x: Column | str) -> Column:
    """Number or text to double; what does not parse becomes null."""
    return col(x).try_cast("double")


# --- hashing with a seed ----------------------------------------------------

def shuffle_key(*cols: Column | str, seed: int = 42) -> Column:
    """Hex digest of the key and a seed.

    Sorting by it is a shuffle that every run, engine and retried task repeats.
    """
    parts = [col(c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def seeded_bucket(buckets: int | Column, *cols: Column | str, seed: int = 42) -> Column:
    """Bucket 0..buckets-1 of a key under a seed (60 bits of the digest)."""
    head = F.conv(F.substring(shuffle_key(*cols, seed=seed), 1, 15), 16, 10).cast("long")
    return F.pmod(head, buckets if isinstance(buckets, Column) else F.lit(buckets))


def hash_bucket(c: Column | str, buckets: int) -> Column:
    """Hash bucket of a string."""
    return seeded_bucket(buckets, c, seed=0)


def hashed_cross(a: Column | str, b: Column | str, buckets: int) -> Column:
    """Cross of two bucketed features hashed into ``buckets``."""
    return seeded_bucket(buckets, a, b, seed=0)


# --- text -------------------------------------------------------------------

def split_bag(c: Column | str, sep: str = "|") -> Column:
    return F.split(col(c), "[" + sep + "]")


def bag_ratio(c: Column | str, sep: str = "|") -> Column:
    """1 / number of entries in the bag, 3 decimals."""
    return half_even(F.lit(1.0) / F.size(split_bag(c, sep)), 3)


def trailing_year(title: Column | str) -> Column:
    """Year of a trailing ``(YYYY)``; null where there is none."""
    t = F.trim(col(title))
    return F.regexp_extract(t, r"\((\d{4})\)$", 1).try_cast("int")


def strip_trailing_year(title: Column | str) -> Column:
    """Title without its trailing ``(YYYY)``."""
    return F.trim(F.regexp_replace(F.trim(col(title)), r"\(\d{4}\)$", ""))


def any_year(title: Column | str) -> Column:
    """Last ``(YYYY)`` anywhere in the title; 0 where absent (G5, second rule)."""
    found = F.regexp_extract(col(title), r".*\((\d{4})\)", 1)
    return F.coalesce(found.try_cast("int"), F.lit(0))


def tidy_genres(c: Column | str) -> Column:
    """Bars to blanks, ``Film-Noir`` to ``Noir``, trimmed."""
    return F.trim(F.replace(F.replace(col(c), F.lit("|"), F.lit(" ")), F.lit("Film-Noir"), F.lit("Noir")))


def edit_similarity(a: Column | str, b: Column | str) -> Column:
    """0..100 similarity from the edit distance; 100 only for equal text."""
    x, y = F.lower(col(a)), F.lower(col(b))
    longest = F.greatest(F.length(x), F.length(y))
    ratio = F.lit(1.0) - F.levenshtein(x, y) / longest
    return F.when(longest == 0, F.lit(100.0)).otherwise(F.rint(ratio * 100))


def compose_point(lat: Column, lon: Column) -> Column:
    """``lat,long`` text."""
    return F.concat_ws(",", lat.cast("string"), lon.cast("string"))


def point_part(point: Column | str, index: int) -> Column:
    """Latitude (0) or longitude (1) of a ``lat,long`` text."""
    return F.get(F.split(col(point), ","), F.lit(index)).try_cast("double")


def pad_list(values: Column, length: int, filler: Column) -> Column:
    """List cut or right-padded to ``length``."""
    return F.slice(F.concat(values, F.array_repeat(filler, length)), 1, length)
