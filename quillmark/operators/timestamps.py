"""Mixed timestamp notations and time zones, brought into one unambiguous form.

Method: every distinct value of a source is read under each notation that fits it and gives a valid date; a value that more
than one reading fits is a mixture. Per source, expectation-maximisation over the mixture weights of the notations lets the
values that only one reading fits speak for the others; the posterior chooses the reading, or the value is marked
ambiguous. A known day order of a source is a prior: it divides the weight of the contrary reading by CONTRARY, and gives a
value that only the contrary order can read the rival reading 'unreadable'. Without a known order the source's own
values decide.

The result is `yyyy`, `yyyy-MM` or `yyyy-MM-dd` without a time of day, else UTC `yyyy-MM-ddTHH:mm:ssZ`, fractions dropped.

Defined cases: null, empty and blank values, words and impossible dates are 'unreadable' with a null norm; a time without a
zone is local to the source's zone (UTC where the source has none): the earlier instant if it occurs twice, moved forward
by the gap if it doesn't occur; a zone nobody knows makes the value unreadable; an unknown source has no prior, and a null
source is one of its own; repeated rows stay; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.operators.skew import heavy_keys, split_join
from quillmark.runtime import staged

#: Posterior from which a reading is taken; under it the value is marked ambiguous.
SURE = 0.9
ROUNDS = 25
#: Prior odds of a source's known day order against the contrary one.
CONTRARY = 1e6
#: Sources with their notations, up to which the fitted weights (under 100 bytes each) are broadcast.
BROADCAST_ROWS = 100_000

# Month names, zone abbreviations in minutes from UTC.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ZONES = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MET": 60, "MEST": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "SAST": 120, "IST": 330, "HKT": 480, "SGT": 480, "AWST": 480, "JST": 540, "KST": 540, "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
    "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
    "AKST": -540, "AKDT": -480, "HST": -600, "BRT": -180, "ART": -180,
}

_MON = r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_WEEKDAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?"
#: (name, pattern of the date part, groups that hold year, month, day; "n" month number, "a" month name, "j" day of the year).
DATES = [
    ("year", r"(\d{4})", "y"),
    ("year-month", r"(\d{4})[-/.](\d{1,2})", "yn"),
    ("year-day of year", r"(\d{4})-(\d{3})", "yj"),
    ("year-month-day", r"(\d{4})([-/.])(\d{1,2})\2(\d{1,2})", "y_nd"),
    ("compact", r"(\d{4})(\d{2})(\d{2})", "ynd"),
    ("month/year", r"(\d{1,2})[/.](\d{4})", "ny"),
    ("day.month.year", r"(\d{1,2})\.(\d{1,2})\.(\d{4})", "dny"),
    ("day/month/year", r"(\d{1,2})/(\d{1,2})/(\d{4})", "dny"),
    ("month/day/year", r"(\d{1,2})/(\d{1,2})/(\d{4})", "ndy"),
    ("year month name", r"(\d{4})[-\s]" + _MON, "ya"),
    ("month name year", _MON + r"[-,\s]*(\d{4})", "ay"),
    ("year month name day", r"(\d{4})[-\s]" + _MON + r"[-\s]" + _DAY, "yad"),
    ("day month name year", _WEEKDAY + _DAY + r"[-\s]*" + _MON + r"[-,\s]*(\d{4})", "day"),
    ("month name day year", _WEEKDAY + _MON + r"\s*" + _DAY + r",?\s+(\d{4})", "ady"),
]
_TIME = r"(?:[T\s]\s*(?:(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?|(\d{2})(\d{2})(\d{2}))\s*([ap]\.?m\.?(?![a-z]))?\s*(z|[+-]\d{2}:?\d{2}|[+-]\d{2}|[a-z]{2,5}|[a-z]+/[a-z_/+-]+[a-z0-9]*)?)?"
_TIMED = ("year-month-day", "compact", "day.month.year", "day/month/year", "month/day/year", "year month name day", "day month name year", "month name day year")


def _groups(pattern: str) -> int:
    return re.compile(pattern).groups


def _guard(v: Column, name: str) -> Column:
    """What a notation needs at least, without a pattern: it spares most values most of the patterns."""
    year_first, letter = v.substr(1, 4).rlike("^[0-9]{4}$"), v.substr(1, 1).rlike("[A-Za-z]")
    kinds = {
        "year": F.length(v) == 4, "year-month": year_first & (F.length(v) <= 7), "year-day of year": year_first & (F.length(v) == 8), "month/year": ~year_first & (F.length(v) <= 7),
        "day.month.year": ~year_first & v.contains("."), "day/month/year": ~year_first & v.contains("/"), "month/day/year": ~year_first & v.contains("/"),
        "month name year": letter, "month name day year": letter, "day month name year": ~year_first,
    }
    return kinds.get(name, year_first)


def _parts(v: Column, name: str, pattern: str, parts: str) -> Column:
    """What the notation sees in the value, as strings ("" where it has no such part); null where it doesn't fit."""
    at = {p: k + 1 for k, p in enumerate(parts)}
    timed = name in _TIMED
    whole = r"(?i)^" + pattern + (_TIME if timed else "") + "$"
    g = lambda k: F.regexp_extract(v, whole, k)
    b = _groups(pattern)
    month = g(at["a"]) if "a" in at else g(at["n"]) if "n" in at else F.lit("")
    fields = {"year": g(at["y"]), "month": month, "day": g(at["d"]) if "d" in at else F.lit(""), "nth": g(at["j"]) if "j" in at else F.lit("")}
    clock = {"hour": F.concat(g(b + 1), g(b + 4)), "minute": F.concat(g(b + 2), g(b + 5)), "second": F.concat(g(b + 3), g(b + 6)), "half": g(b + 7), "zone": g(b + 8)}
    fields |= clock if timed else dict.fromkeys(clock, F.lit(""))
    return F.when(_guard(v, name) & v.rlike(whole), F.struct(F.lit(name).alias("format"), *[c.alias(k) for k, c in fields.items()]))


def _norm(s: Column, zone_of_source: Column, known_zones: list[str]) -> Column:
    """The parts of one reading in the one form, or null if they aren't a valid date and time."""
    num = lambda k: s[k].try_cast("int")
    year, nth = num("year"), num("nth")
    named = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(s["month"], 1, 3))).cast("int")
    month = F.when(s["month"] == "", 1).otherwise(F.coalesce(num("month"), named))
    day = F.when(s["day"] == "", 1).otherwise(num("day"))
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    longest = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = (year >= 1) & month.between(1, 12) & (day >= 1) & (day <= longest)
    date = F.when(valid, F.make_date(year, month, day))
    half = F.lower(F.substring(s["half"], 1, 1))
    hour = F.when(half == "", num("hour")).when(num("hour").between(1, 12), num("hour") % 12 + F.when(half == "p", 12).otherwise(0))
    minute, second = num("minute"), F.coalesce(num("second"), F.lit(0))
    good = hour.between(0, 23) & minute.between(0, 59) & second.between(0, 59)
    # Seconds of the local clock as if it were UTC.
    local = F.when(good, F.unix_date(date).cast("long") * 86400 + hour * 3600 + minute * 60 + second)
    zone = s["zone"]
    digits = F.regexp_replace(zone, "[^0-9]", "")
    hours, minutes = F.substring(digits, 1, 2).try_cast("int"), F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    fixed = F.when(zone.rlike(r"^[+-]") & (hours <= 18) & (minutes <= 59), F.when(zone.startswith("-"), -1).otherwise(1) * (hours * 60 + minutes))
    short = F.try_element_at(F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv]), F.upper(zone))
    region = F.when(zone == "", F.coalesce(zone_of_source, F.lit("UTC"))).when(zone.isin(known_zones), zone)
    as_utc = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(local), region))
    instant = F.when((zone == "") | zone.contains("/"), as_utc).otherwise(local - F.coalesce(fixed, short) * 60)
    return (
        F.when(s["hour"] != "", iso(instant))
        .when(s["nth"] != "", F.when((year >= 1) & (nth >= 1) & (nth <= F.when(leap, 366).otherwise(365)), F.date_add(F.make_date(F.when(year >= 1, year), F.lit(1), F.lit(1)), nth - 1).cast("string")))
        .when(s["month"] == "", F.when(valid, s["year"]))
        .when(s["day"] == "", F.substring(date.cast("string"), 1, 7))
        .otherwise(date.cast("string"))
    )


def iso(seconds: Column) -> Column:
    """UTC seconds as yyyy-MM-ddTHH:mm:ssZ, whatever the zone of the session."""
    rest = F.pmod(seconds, F.lit(86400))
    two = lambda c: F.lpad(F.floor(c).cast("string"), 2, "0")
    day = F.date_from_unix_date(F.floor(seconds / 86400).cast("int")).cast("string")
    return F.concat(day, F.lit("T"), two(rest / 3600), F.lit(":"), two(rest % 3600 / 60), F.lit(":"), two(rest % 60), F.lit("Z"))


def zone_names(spark: SparkSession) -> list[str]:
    """Region zones of the JVM (about 500, a fixed set), which to_utc_timestamp takes without an error."""
    return sorted(z for z in spark._jvm.java.time.ZoneId.getAvailableZoneIds() if "/" in z and not z.startswith(("SystemV", "Etc/")))


def _em(rounds: int):
    def weights(pdf: pd.DataFrame) -> pd.DataFrame:
        """Mixture weights of one source from the counts of its sets of readings (a few dozen rows); a "!" marks a reading against the known order."""
        sets = [([(f.rstrip("!"), 1 / CONTRARY if f.endswith("!") else 1.0) for f in s.split("|")], n) for s, n in zip(pdf["readings"], pdf["n"], strict=True)]
        names = sorted({f for s, _ in sets for f, _ in s})
        w = dict.fromkeys(names, 1 / len(names))
        for _ in range(rounds):
            got = dict.fromkeys(names, 1e-3)  # smoothing: a notation never seen alone keeps a little weight
            for s, n in sets:
                total = sum(w[f] * prior for f, prior in s)
                for f, prior in s:
                    got[f] += n * w[f] * prior / total
            total = sum(got.values())
            w = {f: x / total for f, x in got.items()}
        return pd.DataFrame({"source": pdf["source"].iloc[0], "format": names, "weight": [w[f] for f in names]})

    return weights


def _readings(x: DataFrame, spark: SparkSession) -> DataFrame:
    """x(v, time_zone, day_order) with r: every reading of the value (format, norm, prior)."""
    zones = zone_names(spark)
    contrary = {"day/month/year": "mdy", "month/day/year": "dmy"}
    fits = [_parts(F.col("v"), name, pattern, parts) for name, pattern, parts in DATES]
    x = x.withColumn("fits", F.array_compact(F.array(*fits)))
    zone = F.when(F.col("time_zone").isin(*zones, "UTC", "GMT"), F.col("time_zone"))
    prior = lambda s: functools.reduce(lambda e, kv: e.when((s["format"] == kv[0]) & (F.col("day_order") == kv[1]), 1 / CONTRARY), contrary.items(), F).otherwise(1.0)
    read = F.transform("fits", lambda s: F.struct(s["format"].alias("format"), _norm(s, zone, zones).alias("norm"), prior(s).alias("prior")))
    digits, counts = F.col("v").try_cast("long"), []
    for name, pattern, unit in (("seconds", r"^\d{9,10}$", 1), ("milliseconds", r"^\d{12,13}$", 1000)):
        s = F.when(F.col("v").rlike(pattern), F.floor(digits / unit))
        counts.append(F.struct(F.lit(name).alias("format"), iso(s).alias("norm"), F.lit(1.0).alias("prior")))
    x = x.withColumn("r", F.filter(F.concat(read, F.array(*counts)), lambda s: s["norm"].isNotNull())).drop("fits")
    none = F.array(F.struct(F.lit("unreadable").alias("format"), F.lit(None).cast("string").alias("norm"), F.lit(1.0).alias("prior")))
    return x.withColumn("r", F.when((F.size("r") > 0) & ~F.exists("r", lambda s: s["prior"] == 1), F.concat("r", none)).otherwise(F.col("r")))


def normalise(df: DataFrame, locale: DataFrame, keys: list[str], value: str = "value", source: str = "source", rounds: int = ROUNDS) -> DataFrame:
    """keys, source, value, format, norm, status, posterior of every row. locale: (source, time_zone, day_order), one row per source.

    status is 'read', 'ambiguous' or 'unreadable'; posterior is that of the norm, null where there is none. Values are
    parsed once per source; with no rounds every notation weighs the same. A broadcast of locale or of the fitted weights happens only under Spark's own size threshold
    or BROADCAST_ROWS; the number of sources may grow.
    """
    rows = df.select(*[df[k].alias(f"k{n}") for n, k in enumerate(keys)], df[source].alias("source"), df[value].alias("value"))
    rows = rows.withColumn("pool", F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source")))
    where = locale.select(F.concat(F.lit("="), F.col("source")).alias("pool"), "time_zone", F.lower("day_order").alias("day_order")).dropDuplicates(["pool"])
    x = rows.filter("value is not null").groupBy("pool", "value").agg(F.count(F.lit(1)).alias("n")).join(where, "pool", "left")
    x = x.withColumn("v", F.trim(F.regexp_replace("value", r"[\s ]+", " ")))
    # Parsing costs far more than its few bytes suggest: without a number of tasks they would be merged into a handful.
    x = x.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "pool", "value")
    x = _readings(x, df.sparkSession).select("pool", "value", "n", "r")
    name = F.array_join(F.transform("r", lambda s: F.concat(s["format"], F.when(s["prior"] < 1, "!").otherwise(""))), "|")
    x = staged(x.withColumn("readings", name), "readings")  # read twice; the parsing is the costly part

    sets = x.filter("readings <> ''").groupBy(F.col("pool").alias("source"), "readings").agg(F.sum("n").alias("n"))
    weights = sets.groupBy("source").applyInPandas(_em(rounds), "source string, format string, weight double")
    weights = weights.groupBy(F.col("source").alias("pool")).agg(F.map_from_entries(F.collect_list(F.struct("format", "weight"))).alias("w"))
    if weights.count() <= BROADCAST_ROWS:
        weights = F.broadcast(weights)
    scored = F.transform("r", lambda s: F.struct((F.try_element_at("w", s["format"]) * s["prior"]).alias("p"), s["format"].alias("format"), s["norm"].alias("norm")))
    j = x.join(weights, "pool", "left").withColumn("c", scored).withColumn("best", F.array_max("c"))
    mass = lambda keep: F.aggregate(F.filter("c", keep), F.lit(0.0), lambda a, s: a + s["p"])
    j = j.withColumn("posterior", F.try_divide(mass(lambda s: s["norm"].eqNullSafe(F.col("best.norm"))), mass(lambda s: F.lit(True))))
    sure, void = (F.size("r") == 0) | (F.col("posterior") >= SURE), F.col("best.norm").isNull()
    status = F.when(void & sure, "unreadable").when(sure, "read").otherwise("ambiguous")
    j = j.select("pool", "value", "n", F.when(sure & ~void, F.col("best.format")).alias("format"), F.when(sure, F.col("best.norm")).alias("norm"), status.alias("status"), F.when(~void, F.col("posterior")).alias("posterior"))
    heavy = heavy_keys(x, rows.count()).select("pool", "value", "n")
    got = split_join(rows, j.drop("n"), ["pool", "value"], heavy)
    lacking = {"format": "string", "norm": "string", "status": "string", "posterior": "double"}
    null = rows.filter("value is null").select("*", *[F.lit("unreadable" if c == "status" else None).cast(t).alias(c) for c, t in lacking.items()])
    return got.unionByName(null).select(*[F.col(f"k{n}").alias(k) for n, k in enumerate(keys)], "source", "value", *lacking)
