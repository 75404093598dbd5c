"""Text cut off by field limits or in transfer.

Method: per source the lengths are fitted by maximum likelihood as a log-normal that is right-censored at a candidate
limit (a length with far more values than its neighbours); what lies there beyond the fitted density gives the censoring
posterior at that limit. It is combined with the kind of a value's end:
  - a mark of shortening (an ellipsis) decides;
  - a proper end of a sentence;
  - an unfinished last sentence that begins like sentences of this field do ("opened"); segments whose beginnings mostly
    stand without a full stop (headings, titles, table cells, closing addresses) are judged by their last two words:
    seen as an end, seen going on, or the beginning of a longer word seen after the same word;
  - a closing address, or one that stops short of the address the row is known to mention.
What a kind says is fitted as well: values at a limit are cut with their censoring posterior, and expectation-maximisation per
field finds how often each kind ends a cut and a whole value, and how many values are cut elsewhere. PRIOR stands for a few
values of known kind, for fields without a limit.

Defined cases: null, empty and blank values are never cut; white space at the end doesn't count as text; values of one
word are judged by it alone; texts of any length are read in full; repeated rows are judged each; a null source is a
source of its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.operators.skew import heavy_keys, split_join
from quillmark.runtime import staged

#: Values that a beginning must have been seen in, and the share without an end up to which it opens sentences.
LEAST, LOOSE = 3, 0.3
#: Values that the first word of a beginning is worth against both words together.
BACK_OFF = 20.0
#: Rows of a table of beginnings up to which it is broadcast (under 20 MB); beyond, it is joined by shuffle.
BROADCAST_ROWS = 200_000
#: What is believed of a field before its values are seen, with the weight of PRIOR_SHARE of them: P(kind | cut) and P(kind | cut) / P(kind | whole).
PRIOR = {
    "opened": (0.5, 2000.0), "inside word": (0.25, 1000.0), "goes on": (0.15, 60.0), "unknown": (0.04, 2.0), "seen end": (0.01, 0.03),
    "ended": (0.01, 0.02), "link": (0.0002, 0.001), "short link": (0.02, 1000.0), "decimal": (0.01, 400.0),
}
PRIOR_SHARE = 0.01
#: Values that a limit's censoring posterior is worth against the ends seen there.
LIMIT_VALUES = 10.0
#: Share of cut values elsewhere than at a limit, as it is believed first.
BASE = 0.02
ROUNDS = 40
#: Most that a proper end is as frequent among cut values as among whole ones.
RARER = 0.1
#: An end is a seen one if it makes up at least this share of the places of the pair.
END_SHARE = 0.03

_MARK = r"(…|\.\.\.|\[\s*(\.\.\.|…)\s*\]|\[truncated\]|\(\.\.\.\))$"
_END = r"""[.?!][\p{Pe}\p{Pf}"'”’»]*$"""


def _limits(pdf: pd.DataFrame) -> pd.DataFrame:
    """Censoring posterior of each candidate limit of one source, from its histogram of lengths."""
    h = dict(zip(pdf["len"], pdf["n"], strict=True))
    out = []
    for limit, n in h.items():
        near = [h.get(limit + k, 0) for k in (-5, -4, -3, -2, -1)]
        over = [h.get(limit + k, 0) for k in (1, 2, 3, 4, 5)]
        if n < 4 * (sum(near) / 5 + 1) or n < 4 * (sum(over) / 5 + 1):
            continue
        x = np.log(np.array([k for k in h if k < limit and k > 0], dtype=float))
        w = np.array([h[k] for k in h if k < limit and k > 0], dtype=float)
        above = sum(v for k, v in h.items() if k >= limit)
        if w.sum() < 1:
            continue
        c, mu, sd = math.log(limit), float(np.average(x, weights=w)), 0.5
        for _ in range(40):  # expectation-maximisation of the censored log-normal
            z = (c - mu) / sd
            tail = max(1e-12, 0.5 * math.erfc(z / math.sqrt(2)))
            hazard = math.exp(-z * z / 2) / math.sqrt(2 * math.pi) / tail
            m1, m2 = mu + sd * hazard, sd * sd * (1 + z * hazard) + 2 * mu * (mu + sd * hazard) - mu * mu
            total = w.sum() + above
            new = (float((w * x).sum()) + above * m1) / total
            var = (float((w * x * x).sum()) + above * m2) / total - new * new
            mu, sd = new, math.sqrt(max(1e-4, var))
        z = (c - mu) / sd
        expected = (w.sum() + above) * math.exp(-z * z / 2) / (math.sqrt(2 * math.pi) * sd * limit)
        expected = max(expected, (sum(near) + sum(over)) / 10) + 0.5  # a few values of one length are no limit
        out.append((pdf["field"].iloc[0], pdf["source"].iloc[0], int(limit), min(0.999, max(0.0, 1 - expected / n))))
    return pd.DataFrame(out, columns=["field", "source", "len", "censored"])


def fit_ends(cells: list[tuple[str, int, float, float]]) -> tuple[dict[str, float], float, dict[int, float]]:
    """(P(kind | cut) / P(kind | whole), share cut elsewhere than at a limit, share cut at each limit) of one field.

    cells: (kind, limit or 0, censoring posterior of the limit, values). The shares at limits begin with the censoring posteriors,
    as that of LIMIT_VALUES values, and are fitted to the ends seen there: whole texts of one length are no limit.
    """
    cut = {k: c for k, (c, _) in PRIOR.items()}
    whole = {k: c / r for k, (c, r) in PRIOR.items()}
    z = sum(whole.values())
    first = {k: (cut[k], whole[k] / z) for k in PRIOR}
    cut, whole = ({k: v[i] for k, v in first.items()} for i in (0, 1))
    believed = {limit: min(0.9, c) for _, limit, c, _ in cells if limit} | {0: BASE}
    share = dict(believed)
    for _ in range(ROUNDS):
        a, b = dict.fromkeys(PRIOR, 0.0), dict.fromkeys(PRIOR, 0.0)
        hit, seen = {limit: LIMIT_VALUES * c for limit, c in believed.items()}, dict.fromkeys(believed, LIMIT_VALUES)
        for kind, limit, _, n in cells:
            p = share[limit]
            r = p * cut[kind] / (p * cut[kind] + (1 - p) * whole[kind])
            a[kind], b[kind] = a[kind] + n * r, b[kind] + n * (1 - r)
            hit[limit], seen[limit] = hit[limit] + n * r, seen[limit] + n
        cut, whole = ({k: (v / (sum(x.values()) or 1.0) + PRIOR_SHARE * first[k][i]) / (1 + PRIOR_SHARE) for k, v in x.items()} for i, x in enumerate((a, b)))
        # What ends whole values elsewhere can't come to speak for a cut, however many values of one text share a length.
        cut = {k: min(v, RARER * whole[k]) if PRIOR[k][1] < 1 else v for k, v in cut.items()}
        share = {limit: min(0.999, hit[limit] / seen[limit]) for limit in share}
    return {k: cut[k] / whole[k] for k in PRIOR}, share.pop(0), share


def _first(seg: Column) -> Column:
    return F.regexp_replace(F.substring_index(seg, " ", 1), r"(?i)^(https?://|www\.).*", "<url>")


def _starts(seg: Column) -> Column:
    """Beginnings of a segment from special to general: two words; the first word; the second word after any first."""
    rest = F.substring_index(F.ltrim(F.substr(seg, F.instr(seg, F.lit(" ")))), " ", 1)
    second = F.when(F.instr(seg, " ") > 0, rest).otherwise("")
    return F.array(F.concat_ws(" ", _first(seg), second), _first(seg), F.concat(F.lit("* "), second))


def _letters(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", ""))


def values(df: DataFrame, field: str, id_col: str, text: str, source: str, known: str | None = None) -> DataFrame:
    """(field, id, source, raw, known) of one text column; known: a column with an address the text mentions."""
    return df.select(
        F.lit(field).alias("field"), df[id_col].alias("id"), df[source].cast("string").alias("source"), df[text].alias("raw"),
        (df[known] if known else F.lit(None).cast("string")).alias("known"),
    ).filter(_trimmed(F.col("raw")) != "")


def _trimmed(c: Column) -> Column:
    """Without white space at the end."""
    return F.rtrim(c, F.lit(" \t\n\x0b\f\r\u00a0"))


def _small(df: DataFrame) -> DataFrame:
    """df for a join: broadcast after a check of its size."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _flags(rows: DataFrame) -> DataFrame:
    """rows with v (the value without white space at its end) and what its end shows: ended, marked, short, link, decimal.

    Only the last stretch without a blank is looked at: nothing else of the text can match.
    """
    v, last = F.col("v"), F.col("last")
    rows = rows.withColumn("v", _trimmed(F.col("raw"))).withColumn("last", F.substring_index("v", " ", -1))
    link = F.regexp_extract(last, r"(?i)((https?://|www\.)\S*)$", 1)
    letters, known = _letters(link), _letters(F.col("known"))
    linked = (link != "") & F.col("known").isNotNull()
    rows = rows.withColumn("short", F.coalesce(linked & (F.length(letters) < F.length(known)) & F.startswith(known, letters), F.lit(False)))
    # The known address may have been typed with blanks, so that its last stretch alone is no address.
    closing = F.coalesce((known != "") & F.endswith(_letters(F.right(v, F.length("known") + 16)), known), F.lit(False))
    same = F.coalesce(linked & (letters == known), F.lit(False))
    marked = F.right(v, F.lit(64)).rlike(_MARK) & ~same  # an address may end in dots of its own
    return rows.withColumn("link", (link != "") | closing).withColumn("marked", marked).withColumn("decimal", last.rlike(r"(^|\s)0\.$")).withColumn("ended", last.rlike(_END)).drop("last")


def _ends(rows: DataFrame) -> DataFrame:
    """(field, id, source, len, kind) of all values; kind "marked" is a cut whatever the length."""
    flagged = _flags(rows)
    f = lambda c: F.col(c)
    is_loose = ~f("ended") | f("marked") | (f("short") & f("v").endswith(".")) | f("decimal")

    segments = flagged.select("field", F.explode(F.split("v", r"(?<=[.?!])\s+")).alias("seg")).filter("seg <> ''")
    open_ = F.when(F.col("seg").rlike(_END) & ~F.col("seg").rlike(_MARK), 0).otherwise(1)
    # The second word of an unfinished segment of two may itself be cut: it is no beginning.
    several = F.size(F.split("seg", r"\s+", 3)) > 2
    begun = segments.select("field", _starts(F.col("seg")).alias("starts"), open_.alias("open"), (several | (open_ == 0)).alias("whole"))
    begun = begun.groupBy("field", "starts", "whole").agg(F.count(F.lit(1)).alias("n"), F.sum("open").alias("open"))
    known = F.when(F.col("whole"), F.col("starts")).otherwise(F.slice("starts", 2, 1))
    begun = begun.select("field", F.explode(known).alias("start"), "n", "open").groupBy("field", "start").agg(F.sum("n").alias("n"), F.sum("open").alias("open"))
    openers = begun.filter(F.col("n") >= LEAST).select("field", "start", "n", "open")
    openers = _small(staged(openers, "openers"))

    split = F.split("v", r"(?<=[.?!])\s+")
    loose = flagged.filter(is_loose).select("field", "id", "source", F.length("raw").alias("len"), "marked", "short", "link", "decimal", (F.size(split) > 1).alias("later"), F.element_at(split, -1).alias("seg"))
    a = loose.withColumn("starts", _starts(F.col("seg")))
    for k in range(3):
        o = openers.select("field", F.col("start").alias(f"s{k}"), F.col("n").alias(f"n{k}"), F.col("open").alias(f"o{k}"))
        a = a.withColumn(f"s{k}", F.get("starts", F.lit(k))).join(o, ["field", f"s{k}"], "left")
    # Two words say what their first one says, until they have been seen often themselves; an address says nothing, so that what follows it decides.
    general = F.when(F.col("s1") == "<url>", 1.0).otherwise(F.coalesce(F.col("o1") / F.col("n1"), F.col("o2") / F.col("n2"), F.lit(1.0)))
    without = (F.coalesce("o0", F.lit(0)) + BACK_OFF * general) / (F.coalesce("n0", F.lit(0)) + BACK_OFF)
    opened = without < LOOSE
    # A last word alone that is the beginning of a word that opens sentences.
    begins = F.transform(F.sequence(F.lit(1), F.length("start")), lambda n: F.substr("start", F.lit(1), n))
    heads = openers.filter((F.col("open") < LOOSE * F.col("n")) & (F.instr("start", " ") == 0)).select("field", F.explode(begins).alias("seg")).distinct()
    a = a.join(_small(heads).withColumn("head", F.lit(True)), ["field", "seg"], "left")
    a = a.withColumn("opened", opened | (F.coalesce("head", F.lit(False)) & F.col("later")))
    return a.select("field", "id", "source", "len", "marked", "short", "link", "decimal", "seg", "opened")


def _kinds(a: DataFrame, count: int) -> DataFrame:
    """(field, id, source, len, kind) of the loose values, from what their last two words show."""
    words = F.split(F.regexp_replace(F.lower("seg"), r"\s+", " "), " ")
    b = a.filter("not opened and not marked").withColumn("w", words)
    b = b.withColumn("prev", F.coalesce(F.try_element_at("w", F.lit(-2)), F.lit("^"))).withColumn("word", F.element_at("w", -1))
    pair = ["field", "prev", "word"]
    inner = b.filter(F.size("w") > 1).select("field", F.posexplode("w").alias("k", "word"), "w")
    inner = inner.filter(F.col("k") < F.size("w") - 1).select("field", F.coalesce(F.get("w", F.col("k") - 1), F.lit("^")).alias("prev"), "word")
    types = inner.groupBy(*pair).agg(F.count(F.lit(1)).alias("going"))
    last = b.groupBy(*pair).agg(F.count(F.lit(1)).alias("ending"))
    both = types.unionByName(last.filter("ending > 2").select(*pair, F.col("ending").alias("going")))
    begins = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda n: F.substr("word", F.lit(1), n))
    longer = both.filter(F.length("word") > 1).select("field", "prev", F.explode(begins).alias("word"), "going").groupBy(*pair).agg(F.sum("going").alias("longer"))
    seen = last.join(types, pair, "left").join(longer, pair, "left").fillna(0)
    kind = (
        F.when(F.col("ending") > END_SHARE * (F.col("going") + F.col("longer") + F.col("ending")) + 2, "seen end")
        .when(F.col("going") > 0, "goes on").when(F.col("longer") > 0, "inside word").otherwise("unknown")
    )
    kinds = staged(seen.select(*pair, kind.alias("kind"), "ending"), "ends")
    b = split_join(b.drop("w"), kinds, pair, heavy_keys(kinds, count, "ending"), "ending")
    c = a.filter("opened or marked").withColumn("kind", F.lit("opened"))
    cols = ["field", "id", "source", "len", "kind", "marked", "short", "link", "decimal"]
    c = c.select(*cols).unionByName(b.select(*cols))
    address = F.when(F.col("short"), "short link").when(F.col("link"), "link")
    return c.select("field", "id", "source", "len", F.when(F.col("marked"), "marked").when(F.col("decimal"), "decimal").otherwise(F.coalesce(address, F.col("kind"))).alias("kind"))


def find_cut(rows: DataFrame, fitted: bool = True) -> DataFrame:
    """(field, id, source, evidence, posterior) of the values() whose end is missing; fields may be united beforehand, each is judged by itself.

    fitted: whether lengths and ends are fitted; else PRIOR and BASE hold as they stand, and no limit is known.
    """
    sizes = rows.groupBy("field", "source", F.length("raw").alias("len")).agg(F.count(F.lit(1)).alias("n"))
    sizes = staged(sizes.withColumn("pool", F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))), "lengths")
    count = sizes.agg(F.sum("n")).first()[0] or 0
    limits = sizes.select("field", F.col("pool").alias("source"), "len", "n").groupBy("field", "source").applyInPandas(_limits, "field string, source string, len int, censored double")
    limits = staged(limits if fitted else limits.filter("false"), "limits").withColumnRenamed("source", "pool")
    # What lies at a limit: its length, and the highest censoring posterior that a source gives it.
    at = ["field", "pool", "len"]
    limits = limits.groupBy(*at).agg(F.max("censored").alias("censored"))
    loose = _kinds(staged(_ends(rows), "loose"), count)
    pool = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
    loose = staged(loose.withColumn("pool", pool).join(_small(limits), at, "left"), "kinds")
    # Cells of kinds and limits: a few for each length that is a limit, whatever the number of sources.
    cell = ["field", F.when(F.col("censored").isNotNull(), F.col("len")).otherwise(0).alias("limit")]
    both = [F.count(F.lit(1)).alias("n"), F.coalesce(F.max("censored"), F.lit(0.0)).alias("c")]
    found = loose.groupBy(*cell, "kind").agg(*both).collect()
    every = sizes.join(_small(limits), at, "left").groupBy(*cell).agg(F.sum("n").alias("n"), both[1]).collect()
    fits, ratio = [], F.lit(1.0)
    for field in sorted({r.field for r in every}):
        cells = [(r.kind, r.limit, r.c, float(r.n)) for r in found if r.field == field and r.kind != "marked"]
        for e in every:
            if e.field == field:
                ended = e.n - sum(r.n for r in found if r.field == field and r.limit == e.limit)
                cells.append(("ended", e.limit, e.c, float(max(0, ended))))
        says, base, shares = fit_ends(cells) if fitted else ({k: v[1] for k, v in PRIOR.items()}, BASE, {})
        for kind, x in says.items():
            ratio = F.when((F.col("field") == field) & (F.col("kind") == kind), x).otherwise(ratio)
        fits += [(field, limit, float(max(base, share))) for limit, share in {0: base, **shares}.items()]
    fits = rows.sparkSession.createDataFrame(fits, "field string, limit int, p double")
    judged = loose.withColumn("limit", F.when(F.col("censored").isNotNull(), F.col("len")).otherwise(0)).join(_small(fits), ["field", "limit"])
    odds = F.col("p") / (1 - F.col("p")) * ratio
    posterior = F.when(F.col("kind") == "marked", 1.0).otherwise(odds / (1 + odds))
    return judged.select("field", "id", "source", F.col("kind").alias("evidence"), posterior.alias("posterior")).filter("posterior >= 0.5")


def cut_rates(rows: DataFrame) -> DataFrame:
    """(field, source, values, cut, share): how often each source truncates each field; a null source is one of its own."""
    total = rows.groupBy("field", "source").agg(F.count(F.lit(1)).alias("values"))
    cut = find_cut(rows).groupBy(F.col("field").alias("f"), F.col("source").alias("s")).agg(F.count(F.lit(1)).alias("cut"))
    both = total.join(cut, (F.col("field") == F.col("f")) & F.col("source").eqNullSafe(F.col("s")), "left").drop("f", "s").fillna(0, ["cut"])
    return both.withColumn("share", F.col("cut") / F.col("values"))
