"""Variant spellings of names typed by people.

Method: a symmetric-delete neighbourhood index on tokens. Every distinct token of LONG letters or more is stored under
itself and under each of its deletions of one letter; tokens that meet there and are one edit apart (insertion, deletion,
substitution or transposition) are neighbours, and a rarer one takes the most frequent neighbour as its root. Names are
then aligned token by token by optimal assignment, permitting initials, abbreviations and nicknames:
  - a person is a surname root with a given-name root (nicknames stand for their name); names with initials alone are
    aligned with the full names of their surname and join the only one that fits, else those with the same initials;
  - an organisation has an anchor, its rarest and longest token (the place); the distinct word sets of an anchor are
    aligned with each other at the least cost, and those that align completely are one organisation.

Spellings of an entity are linked through its key; nothing is compared across anchors or surnames, and copies of a
spelling are one spelling from the start.

Defined cases: null, empty and blank names are left out; names are trimmed, otherwise kept as stored; a name without
any letter is an entity of its own; titles and acronyms in brackets don't count; ambiguous initials (two full names
fit) are linked to neither; an empty table gives an empty result; names of any length are aligned in full; a nickname of
several given names stands for itself.
"""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.runtime import staged

LONG = 4
#: Tokens up to which all assignments are tried; the way of longer names gives the same in polynomial time.
FEW = 5
#: Rows of the list of given names up to which it is broadcast.
BROADCAST_ROWS = 10_000
#: Titles, words that don't distinguish organisations, and words with their usual short forms.
TITLES = ["dr", "prof", "professor", "mr", "mrs", "ms", "sir", "phd", "md", "jr", "sr"]
FILL = ["the", "of", "for", "and", "in", "at", "f", "on"]
SHORT = {
    "university": ["univ", "u", "uni"], "institute": ["inst", "institut", "institution"], "center": ["ctr", "centre", "cntr", "cent"], "laboratory": ["lab", "l", "labs", "laboratories"], "hospital": ["hosp", "h"],
    "medical": ["med", "m"], "medicine": ["med"], "school": ["sch", "s"], "research": ["res", "r"], "council": ["cncl", "c"], "technical": ["tech", "t"], "technology": ["tech", "t"], "national": ["natl", "nat", "n"],
    "foundation": ["fdn", "found", "fnd", "f"], "science": ["sci"], "sciences": ["sci"], "biology": ["biol", "bio"], "department": ["dept", "dep"], "college": ["coll", "c"], "academy": ["acad"],
    "international": ["intl", "int"], "society": ["soc"], "association": ["assoc"], "engineering": ["eng"],
}


def _deletes(w: Column) -> Column:
    each = F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))
    return F.array_distinct(F.concat(F.array(w), each))


def _one_edit(a: Column, b: Column) -> Column:
    """Distance 1, a transposition of neighbours being one edit."""
    n = F.length(a)
    k = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: F.when(acc > 0, acc).when(F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)), i).otherwise(0))
    swapped = (n == F.length(b)) & (k > 0) & (k < n) & (b == F.concat(F.substr(a, F.lit(1), k - 1), F.substr(a, k + 1, F.lit(1)), F.substr(a, k, F.lit(1)), F.substr(a, k + 2)))
    return (F.levenshtein(a, b) <= 1) | swapped


def token_roots(tokens: DataFrame) -> DataFrame:
    """(kind, token, root) of tokens(kind, token, n): the token one edit away that clearly weighs more, else the token itself.

    A token weighs its count and the number of its neighbours: slips of one word lie around it, not around each other.
    """
    keys = tokens.filter(F.length("token") >= LONG).select("kind", "token", F.explode(_deletes(F.col("token"))).alias("key"))
    a, b = keys.alias("a"), keys.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.kind") == F.col("b.kind")) & (F.col("a.token") < F.col("b.token")))
    near = met.select("a.kind", F.col("a.token").alias("x"), F.col("b.token").alias("y")).distinct().filter(_one_edit(F.col("x"), F.col("y")))
    near = staged(near.unionByName(near.select("kind", F.col("y").alias("x"), F.col("x").alias("y"))), "near")
    weight = tokens.join(near.groupBy("kind", F.col("x").alias("token")).agg(F.count(F.lit(1)).alias("k")), ["kind", "token"]).select("kind", "token", "n", (F.col("n") + F.col("k")).alias("w"))
    own = weight.select("kind", F.col("token").alias("x"), "n", F.col("w").alias("wx"))
    other = weight.select("kind", F.col("token").alias("y"), F.col("w").alias("wy"))
    # A slip is rarer than the word; of two words alike in everything the later one is taken for the slip.
    more = (F.col("wy") >= 2 * F.col("wx")) | ((F.col("wy") > F.col("wx")) & (F.col("n") <= 2)) | ((F.col("wy") == F.col("wx")) & (F.col("n") == 1) & (F.col("y") < F.col("x")))
    best = near.join(own, ["kind", "x"]).join(other, ["kind", "y"]).filter(more).groupBy("kind", F.col("x").alias("token")).agg(F.max_by("y", F.struct("wy", "y")).alias("root"))
    roots = tokens.join(best, ["kind", "token"], "left").select("kind", "token", F.coalesce("root", "token").alias("root"))
    # The root of a root: a chain of two edits ends at the most frequent form.
    again = roots.select("kind", F.col("token").alias("root"), F.col("root").alias("top")).filter("root <> top")
    return roots.join(again, ["kind", "root"], "left").select("kind", "token", F.coalesce("top", "root").alias("root"))


def assignment(a: tuple[str, ...], b: tuple[str, ...], cost) -> float:
    """Least total cost of pairing all tokens of a with all of b, one to one; infinite if they can't be paired."""
    if len(a) != len(b):
        return float("inf")
    if len(a) > FEW:
        return _matching(a, b, cost)
    layer = {0: 0.0}
    for x in a:
        after: dict[int, float] = {}
        for mask, c in layer.items():
            for k, y in enumerate(b):
                if not mask >> k & 1:
                    t = c + cost(x, y)
                    if t < after.get(mask | 1 << k, float("inf")):
                        after[mask | 1 << k] = t
        layer = after
    return min(layer.values(), default=float("inf"))


def _matching(a: tuple[str, ...], b: tuple[str, ...], cost) -> float:
    """assignment() in polynomial time, by shortest augmenting paths (Bellman-Ford, as steps back lower the cost)."""
    n, inf = len(a), float("inf")
    c = [[cost(x, y) for y in b] for x in a]
    of: list[int] = [-1] * n  # row of each column
    for start in range(n):
        dist, back, queue = list(c[start]), [-1] * n, [k for k in range(n) if c[start][k] < inf]
        while queue:
            j = queue.pop(0)
            i = of[j]
            if i < 0:
                continue
            for k in range(n):
                t = dist[j] - c[i][j] + c[i][k]
                if k != j and t < dist[k] - 1e-9:
                    dist[k], back[k] = t, j
                    queue.append(k)
        j = min((k for k in range(n) if of[k] < 0), key=dist.__getitem__)
        if dist[j] == inf:
            return inf
        while back[j] >= 0:
            of[j], j = of[back[j]], back[j]
        of[j] = start
    return sum(c[i][j] for j, i in enumerate(of))


def _subsequence(short: str, word: str) -> bool:
    it = iter(word)
    return all(ch in it for ch in short)


def word_cost(x: str, y: str) -> float:
    """0 for one word, less than 1 for a short form of the other, else infinite."""
    if x == y:
        return 0.0
    if x in SHORT.get(y, ()) or y in SHORT.get(x, ()):
        return 0.2
    if any(x in v and y in v for v in SHORT.values()):
        return 0.3
    s, w = sorted((x, y), key=len)
    if len(s) >= 3 and len(w) - len(s) >= 2 and w.startswith(s):
        return 0.4
    if len(s) in (3, 4) and len(w) >= 5 and s[0] == w[0] and s[-1] == w[-1] and _subsequence(s, w):
        return 0.6
    return float("inf")


def _shapes(pdf: pd.DataFrame) -> pd.DataFrame:
    """Organisations of one anchor: each distinct word set gets the number of its class (word sets, not rows: a vocabulary bounds them)."""
    shapes = sorted({tuple(s) for s in pdf["shape"]}, key=lambda s: (-sum(map(len, s)), s))
    head: dict[tuple, tuple] = {}
    full: list[tuple] = []
    by_size: dict[int, list[tuple]] = {}
    for s in shapes:
        # Longest forms come first: a shorter one joins the full form that it aligns with at the least cost.
        best = min(((assignment(s, h, word_cost), h) for h in by_size.get(len(s), ())), default=(float("inf"), s))
        head[s] = best[1] if best[0] < float("inf") else s
        if head[s] == s:
            full.append(s)
            by_size.setdefault(len(s), []).append(s)
    number = {s: " ".join(s) for s in full}
    return pd.DataFrame({"anchor": pdf["anchor"], "shape": pdf["shape"], "entity": [number[head[tuple(s)]] for s in pdf["shape"]]})


def organisations(names: DataFrame) -> DataFrame:
    """(name, entity) of names(name)."""
    clean = F.regexp_replace(F.regexp_replace(F.lower("name"), r"\([^)]*\)", " "), r"[.'’]", "")
    words = names.select("name", F.filter(F.split(clean, r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.isin(*FILL[:-2])).alias("w"))
    words = staged(words.filter(F.size("w") > 0).select("name", F.transform("w", lambda w: F.when(w == "centre", "center").otherwise(w)).alias("w")), "orgs")
    tokens = words.select(F.explode(F.array_distinct("w")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("org"))
    roots = token_roots(tokens)
    each = words.select("name", F.posexplode("w").alias("pos", "token")).join(roots.select("token", "root"), "token")
    df = each.select("name", "root").distinct().groupBy("root").agg(F.count(F.lit(1)).alias("df"))
    each = each.join(df, "root")
    weight = F.col("df") / F.pow(F.length("root"), F.lit(3))
    known = F.col("root").isin(*{w for k, v in SHORT.items() for w in (k, *v)}, *FILL)
    weight = weight + F.when(known, 1e6).otherwise(0.0)
    pick = each.groupBy("name").agg(F.min_by("root", F.struct(weight.alias("x"), "root")).alias("anchor"), F.collect_list("root").alias("roots"))
    rest = F.array_sort(F.filter(F.array_except(F.col("roots"), F.array("anchor")), lambda w: ~w.isin(*FILL)))
    pick = staged(pick.select("name", "anchor", rest.alias("shape")), "picked")
    classes = pick.select("anchor", "shape").distinct().groupBy("anchor").applyInPandas(_shapes, "anchor string, shape array<string>, entity string")
    return pick.join(classes, ["anchor", "shape"]).select("name", F.concat_ws("|", "anchor", "entity").alias("entity"))


def persons(names: DataFrame, given: DataFrame) -> DataFrame:
    """(name, entity) of names(name); given: (given_name, nickname), a list of bounded size.

    entity is null where a name with initials fits more than one person.
    """
    full = given.select(F.lower("given_name").alias("token"), F.lower("given_name").alias("given"))
    short = given.select(F.lower("nickname").alias("token"), F.lower("given_name").alias("given"))
    both = full.withColumn("own", F.lit(True)).unionByName(short.withColumn("own", F.lit(False))).filter("token is not null")
    ref = both.groupBy("token").agg(F.max("own").alias("own"), F.countDistinct("given").alias("n"), F.min("given").alias("given"))
    ref = staged(ref.select("token", F.when(F.col("own") | (F.col("n") > 1), F.col("token")).otherwise(F.col("given")).alias("given")), "given")
    small = F.broadcast if ref.count() <= BROADCAST_ROWS else (lambda df: df)
    clean = F.regexp_replace(F.trim("name"), r"(?i)^(" + "|".join(TITLES) + r")\b\.?\s+|,?\s+(" + "|".join(TITLES[-4:]) + r")\.?$", "")
    parts = F.filter(F.split(clean, r"[^\p{L}\p{N}'’-]+"), lambda w: w != "")
    x = names.select("name", parts.alias("w"), F.instr(clean, ",").alias("comma"))
    x = staged(x.filter(F.size("w") > 0), "persons")
    # Initials: one letter, or two or three capitals without a vowel-consonant reading, at the end of the name.
    initials = lambda w: (F.length(w) == 1) | ((F.length(w) <= 3) & (w == F.upper(w)))
    each = x.select("name", "comma", F.size("w").alias("size"), F.posexplode("w").alias("pos", "word"))
    each = each.withColumn("initial", initials(F.col("word"))).withColumn("token", F.lower("word"))
    long = each.filter("not initial")
    counts = long.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    # Names of the list outweigh every count, so that slips of given names go to the list.
    counts = counts.join(small(ref.select("token", F.lit(1).alias("listed"))), "token", "full").select(F.lit("person").alias("kind"), "token", (F.coalesce("n", F.lit(0)) + F.when(F.col("listed") == 1, 10**12).otherwise(0)).alias("n"))
    roots = token_roots(counts)
    long = long.join(roots.select("token", "root"), "token", "left").withColumn("root", F.coalesce("root", "token"))
    long = long.join(small(ref.withColumnRenamed("token", "root")), "root", "left")
    # The surname: before a comma the first word; else the last word that isn't a listed given name, else the last.
    last = F.when(F.col("comma") > 0, F.when(F.col("pos") == 0, 3).otherwise(0)).otherwise(F.when(F.col("given").isNull(), 2).otherwise(1))
    s = long.groupBy("name").agg(F.max_by(F.struct("pos", "root"), F.struct(last.alias("k"), F.col("pos").alias("p"))).alias("s"))
    g = long.join(s, "name").filter("pos <> s.pos").groupBy("name").agg(F.min_by(F.coalesce("given", "root"), "pos").alias("given"))
    i = each.filter("initial").groupBy("name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda t: t["token"]), "").alias("initials"))
    p = s.select("name", F.col("s.root").alias("surname")).join(g, "name", "left").join(i, "name", "left").fillna("", ["initials"])
    p = staged(p, "parsed")
    # A full name's letters: its given name's initial, then its other initials; the letters of an entity are those of its spellings.
    whole = p.filter("given is not null").groupBy("surname", "given").agg(F.collect_set(F.when(F.col("initials") != "", F.substring("initials", 1, 1))).alias("middle"))
    part = p.filter("given is null")
    fit = part.join(whole.withColumnRenamed("given", "full"), "surname").filter(F.substring("full", 1, 1) == F.substring("initials", 1, 1))
    second = F.substring("initials", 2, 1)
    exact = (second != "") & F.array_contains("middle", second)
    fit = fit.filter((second == "") | (F.size("middle") == 0) | F.array_contains("middle", second)).withColumn("exact", exact)
    fit = fit.groupBy("name").agg(F.count(F.lit(1)).alias("fits"), F.count_if("exact").alias("exact"), F.min("full").alias("any"), F.min(F.when(F.col("exact"), F.col("full"))).alias("sure"))
    part = part.join(fit, "name", "left")
    chosen = F.when(F.col("exact") == 1, F.col("sure")).when(F.col("fits") == 1, F.col("any"))
    alone = F.when(F.col("fits").isNull(), F.concat(F.lit("."), F.substring("initials", 1, 1)))
    part = part.select("name", "surname", F.coalesce(chosen, alone).alias("g"))
    done = p.filter("given is not null").select("name", "surname", F.col("given").alias("g")).unionByName(part)
    return done.select("name", F.when(F.col("g").isNotNull(), F.concat_ws("|", "surname", "g")).alias("entity"))


def spelling_links(entities: DataFrame) -> DataFrame:
    """(name_a, name_b): each pair of different spellings (name) of one entity; names without an entity link to none."""
    e = entities.filter("entity is not null")
    return e.alias("a").join(e.alias("b"), "entity").filter("a.name < b.name").select(F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b"))


def spellings(columns: list[tuple[DataFrame, str]], split: str | None = None) -> DataFrame:
    """(name, n): the distinct trimmed spellings of the columns, split where a pattern is given, with their counts."""
    parts = []
    for df, c in columns:
        v = F.explode(F.split(df[c], split)) if split else df[c]
        parts.append(df.select(v.alias("name")).select(F.trim("name").alias("name")))
    both = functools.reduce(DataFrame.unionByName, parts)
    return both.filter("name <> ''").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
