"""Garbled text from a wrong character encoding.

Method: latent encoding chains. A chain says which bytes were read by which codec. Two families are looked at: UTF-8
read by a single-byte codec, once or several times over (its traces are byte sequences that are valid UTF-8 again), and
single-byte text read by another single-byte codec (its traces are words that are likelier under another chain, by a
character model of the corpus). A record shows every chain that explains it nearly as well as its best one. Expectation-
maximisation per source over the chains' mixture weights, no damage being one of them, pools the weak evidence of a source's
records; each record is then repaired by the chain of the highest posterior, or left as it is.

The model counts neighbouring characters: those that single-byte codecs know by themselves, all others by their block of 4,096
code points. That bounds it (about a thousand kinds, a million pairs of them) whatever the corpus.

Defined cases: null, empty and pure ASCII texts are never damaged; a text with U+FFFD, or with traces whose bytes are
incomplete, has lost characters and gets no restored text; texts of any length and layers of any number are handled in full;
a record without a source belongs to the pool of null; repeated rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.operators.skew import heavy_keys, split_join
from quillmark.runtime import staged

#: Codecs that UTF-8 bytes were read by. The first takes bytes that cp1252 leaves open as latin-1 does.
READ_BY = ["cp1252", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8_r", "cp866", "iso8859_15"]
#: Single-byte chains: (codec of the bytes, codec they were read by).
SWAPS = [
    ("koi8_r", "cp1251"), ("cp1251", "koi8_r"), ("cp1251", "cp1252"), ("koi8_r", "cp1252"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("cp866", "cp1252"),
    ("iso8859_5", "cp1251"), ("mac_cyrillic", "cp1251"), ("cp866", "koi8_r"), ("koi8_r", "cp866"), ("cp1251", "mac_roman"), ("koi8_r", "mac_roman"),
    ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp1252", "cp437"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1252", "cp850"), ("cp1252", "cp1251"), ("cp1252", "koi8_r"),
]
#: Chains whose gain is less than the best one's by up to this compete with it, at most RIVALS of them: others have less than a millionth of its likelihood.
MARGIN, RIVALS = 14.0, 4
#: Gain under the first model from which a record is looked at again under the second, which knows the damage.
LOOK = -5.0
#: Log odds against a change of the chain from one word to the next, and against any single-byte damage in a record before its source is known.
SWITCH, PRIOR = -7.0, -6.0
ROUNDS = 6
#: Code points of a block, whose characters outside the codecs count as one kind.
BLOCK = 4096


def _to_bytes(codec: str) -> dict[str, int]:
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            pass
    if codec == "cp1252":
        for b in range(128, 160):
            out.setdefault(chr(b), b)
    return out


_BYTES = {c: _to_bytes(c) for c in {*READ_BY, *(x for s in SWAPS for x in s)}}
_CHARS = {c: {b: ch for ch, b in m.items() if not (c == "cp1252" and 0x80 <= ord(ch) < 0xA0 and any(k != ch and v == b for k, v in m.items()))} for c, m in _BYTES.items()}


#: For each of SWAPS, what a character read in error stands for.
_TABLES = [{ord(ch): _CHARS[wrote][b] for ch, b in _BYTES[read].items() if b in _CHARS[wrote]} for wrote, read in SWAPS]


def _sequences(codec: str) -> re.Pattern:
    """Characters that, written by the codec, are one UTF-8 character of two to four bytes."""
    m = _BYTES[codec]

    def cls(lo, hi):
        return "[" + "".join(re.escape(ch) for ch, b in m.items() if lo <= b <= hi) + "]"

    c = cls(0x80, 0xBF)
    parts = []
    for lead, rest in (((0xC2, 0xDF), 1), ((0xE0, 0xEF), 2), ((0xF0, 0xF4), 3)):
        head = cls(*lead)
        if head != "[]" and c != "[]":
            parts.append(head + c + "{%d}" % rest)
    return re.compile("|".join(parts)) if parts else re.compile("(?!)")


_SEQUENCES = {c: _sequences(c) for c in READ_BY}


class Model:
    """Log frequencies of characters and of neighbouring characters around those outside ASCII."""

    def __init__(self, pairs: dict[str, int]):
        self.n = max(1, sum(pairs.values()))
        self.pairs = pairs
        single: Counter = Counter()
        for p, k in pairs.items():
            if ord(p[1]) > 127:
                single[p[1]] += k
        self.single, self.m = single, max(1, sum(single.values()))
        self._one: dict[str, float] = {}
        self._two: dict[str, float] = {}
        self.runs: dict[str, list[float] | tuple] = {}
        self._gains: dict[str, list[float]] = {}
        self._better: dict[str, list[tuple[int, float]]] = {}

    def gains(self, w: str) -> list[float]:
        """What each chain of SWAPS gains in log likelihood on the word."""
        v = self._gains.get(w)
        if v is None:
            if len(self._gains) > 200_000:
                self._gains.clear()
            p = self.word(w)
            v = self._gains[w] = [self.word(w.translate(t)) - p if all(ord(ch) < 128 or ord(ch) in t for ch in w) else -50.0 for t in _TABLES]
        return v

    def better(self, words: list[str]) -> dict[int, float]:
        """Sum of the words' positive gains by chain, where there are any."""
        total: dict[int, float] = {}
        for w in words:
            good = self._better.get(w)
            if good is None:
                if len(self._better) > 200_000:
                    self._better.clear()
                good = self._better[w] = [(n, g) for n, g in enumerate(self.gains(w)) if g > 0]
            for n, g in good:
                total[n] = total.get(n, 0.0) + g
        return total

    def one(self, ch: str) -> float:
        v = self._one.get(ch)
        if v is None:
            v = self._one[ch] = math.log((self.single.get(_kind(ch), 0) + 0.5) / self.m) + _share(ch)
        return v

    def word(self, w: str) -> float:
        """Of a word between its neighbours."""
        total, prev = 0.0, _kind(w[0])
        for ch in w[1:]:
            p = prev + _kind(ch)
            v = self._two.get(p)
            if v is None:
                v = self._two[p] = math.log((self.pairs.get(p, 0) + 0.5) / self.n)
            total += v
            prev = p[1]
        return total


_ALPHABET = {ch for m in _BYTES.values() for ch in m}


def _kind(ch: str) -> str:
    if ord(ch) > 127:
        return ch if ch in _ALPHABET else chr(max(0x100, ord(ch) // BLOCK * BLOCK) | 1)
    return "a" if ch.islower() else "A" if ch.isupper() else "0" if ch.isdigit() else " "


def _share(ch: str) -> float:
    """Log share of a character in its kind."""
    return 0.0 if ch in _ALPHABET else -math.log(BLOCK)


def pairs_of(text: str, into: Counter) -> None:
    """Counts the neighbours of every character outside ASCII."""
    for x in _RUN.finditer(text):
        prev = _kind(text[x.start() - 1]) if x.start() else " "
        for ch in map(_kind, x.group()):
            into[prev + ch] += 1
            prev = ch
        into[prev + (_kind(text[x.end()]) if x.end() < len(text) else " ")] += 1


_RUN = re.compile(r"[^\x00-\x7f]+")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
#: What follows a character outside ASCII within its word: a letter may be read as a sign, so all that isn't ASCII belongs to it.
_TAIL = re.compile(r"[^\x00-\x7f][A-Za-z\x80-\U0010ffff]*")


def words_of(text: str) -> list[tuple[int, int]]:
    """(start, end) of the words with characters outside ASCII."""
    out = []
    for x in _TAIL.finditer(text):
        i = x.start()
        while i and text[i - 1] in _LETTERS:
            i -= 1
        out.append((i, x.end()))
    return out


def _neighboured(text: str, words: list[tuple[int, int]]) -> list[str]:
    """The words with the character before and the one after, by kind: a dash between digits is another pair than one between blanks."""
    at = lambda i: _kind(text[i]) if 0 <= i < len(text) else " "
    return [at(i - 1) + text[i:j] + at(j) for i, j in words]


def _put_right(text: str, codec: str, model: Model) -> tuple[float, str]:
    """(gain in log likelihood, text) with every trace of UTF-8 read by the codec put right."""
    m, gain = _BYTES[codec], 0.0

    def back(x):
        nonlocal gain
        seen = x.group()
        try:
            s = bytes(m[ch] for ch in seen).decode("utf-8")
        except UnicodeDecodeError:
            return seen
        if ord(s) < 0xA0 and codec != "cp1252":
            return seen
        # C1 controls come up only between the layers of repeated readings.
        gain += (-9.0 if ord(s) < 0xA0 else model.one(s)) - sum(map(model.one, seen))
        return s

    out = _SEQUENCES[codec].sub(back, text)
    return gain, out


def _utf8_gains(text: str, model: Model) -> list[float]:
    """Gain of each codec of the first family for one layer; a trace is a run of two or more characters outside ASCII."""
    total = [0.0] * len(READ_BY)
    for run in _RUN.findall(text):
        if len(run) < 2:
            continue
        gains = model.runs.get(run)
        if gains is None:
            if len(model.runs) > 200_000:
                model.runs.clear()
            gains = [_put_right(run, codec, model)[0] for codec in READ_BY]
            model.runs[run] = gains = gains if any(gains) else ()
        for k, g in enumerate(gains):
            total[k] += g
    return total


def _turned(words: list, states: list[int], text: str, table: dict) -> str:
    """The text with the words of state 1, and what lies between neighbours of them, under the table."""
    hit = [k for k, s in enumerate(states) if s]
    out, at, k = [], 0, 0
    while k < len(hit):
        last = k
        while last + 1 < len(hit) and hit[last + 1] == hit[last] + 1:
            last += 1
        lo, hi = words[hit[k]][0], words[hit[last]][1]
        out += [text[at:lo], text[lo:hi].translate(table)]
        at, k = hi, last + 1
    return "".join(out) + text[at:]


def _swaps(text: str, model: Model) -> list[tuple[float, int, list, list[int]]]:
    """(gain, chain, words, states) of the gaining chains of the second family: words under the chain and under none, by Viterbi with a switch cost.

    Any gain is evidence, even that of a single word; the source decides whether it holds.
    """
    words = words_of(text)
    plain = _neighboured(text, words)
    able = [n for n, g in model.better(plain).items() if g + SWITCH > 0]
    if not able:
        return []
    scores = [model.gains(w) for w in plain]
    found = []
    for n in sorted(able):
        score = [g[n] for g in scores]
        stay, turned, back = 0.0, SWITCH, []
        for g in score:
            a, b = (0, stay) if stay >= turned + SWITCH else (1, turned + SWITCH)
            c, d = (1, turned) if turned >= stay + SWITCH else (0, stay + SWITCH)
            back.append((a, c))
            stay, turned = b, d + g
        if max(stay, turned) <= 0:
            continue
        state, states = (1 if turned > stay else 0), []
        for a, c in reversed(back):
            states.append(state)
            state = c if state else a
        states.reverse()
        if any(states):
            found.append((max(stay, turned), n, words, states))
    return found


def _options(text: str, model: Model, rivals: int = RIVALS) -> list[tuple[float, str, str]]:
    """(gain, chain, text) of the gaining chains on one layer that rival the best, the best first; of chains with one result the first."""
    options = [(g, f"utf-8 read by {c}", c) for g, c in zip(_utf8_gains(text, model), READ_BY, strict=True) if g > 0]
    options += [(s[0], f"{SWAPS[s[1]][0]} read by {SWAPS[s[1]][1]}", s) for s in _swaps(text, model)]
    options.sort(key=lambda o: -o[0])
    out: dict[str, tuple[float, str, str]] = {}
    for gain, chain, how in options:
        if gain < options[0][0] - MARGIN or len(out) == rivals:
            break
        now = _put_right(text, how, model)[1] if isinstance(how, str) else _turned(how[2], how[3], text, _TABLES[how[1]])
        if now not in out:
            out[now] = (gain, chain, now)
    return list(out.values())


def _trace(text: str, model: Model) -> bool:
    """Whether a chain comes near to a gain."""
    if "\ufffd" in text or any(g > LOOK for g in _utf8_gains(text, model) if g):
        return True
    return any(g + SWITCH > LOOK for g in model.better(_neighboured(text, words_of(text))).values())


#: The beginning of a trace without its end.
_TORN = re.compile("[ÃÂ](?=[\\s.,;]|$)|â€(?![\x80-\xbf‘-™])")


def diagnose(text: str, model: Model, rivals: int = RIVALS) -> list[tuple[str, float, str]]:
    """(chain, gain, restored text or "" if characters are lost) of the chains that may explain a text, the best first; none for a text without traces.

    A chain and the one with a layer more are rivals: what is gained by a layer needn't be worth it.
    """
    if "\ufffd" in text:
        return [("lost", 50.0, "")]
    found = []
    for total, chain, now in _options(text, model, rivals):
        stages = [(chain, total, now)]
        # Layer under layer: each gains, so that no text comes twice.
        while under := _options(now, model, 1):
            gain, layer, now = under[0]
            total, chain = total + gain, f"{chain} < {layer}"
            stages.append((chain, total, now))
        for chain, gain, now in stages:
            if gain >= total - MARGIN:
                torn = "cp1252" in chain and _TORN.search(now) and not _TORN.search(text.upper() if text.isupper() else "")
                found.append((chain, gain, "" if torn else now))
    return sorted(found, key=lambda f: -f[1])


def likeliest(found: list[tuple[str, float, str]]) -> str | None:
    """The restored text of the likeliest of some chains before anything is known of the source; None if no damage is likelier."""
    score, now = max(((gain + PRIOR * (chain.count(" < ") + 1), now) for chain, gain, now in found), default=(0.0, None), key=lambda x: x[0])
    return now if score > 0 else None


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    c: Counter = Counter()
    for pdf in batches:
        for t in pdf["text"]:
            pairs_of(t, c)
    if c:  # an empty column would have no type
        yield pd.DataFrame({"pair": list(c), "n": list(c.values())})


def character_model(texts: DataFrame) -> dict[str, int]:
    """Counts of neighbouring kinds of characters over all texts (column text); their number is bounded by that of the kinds."""
    c = texts.mapInPandas(_counts, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return {r.pair: r.n for r in c.collect()}


def _looked(pairs: Broadcast, id_type: str):
    """Records that show a trace under the first model, with the best repair if it gains."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(pairs.value)
        for pdf in batches:
            rows = []
            for i, s, t in zip(pdf["id"], pdf["pool"], pdf["text"], strict=True):
                if _trace(t, model):
                    rows.append((i, s, t, likeliest(diagnose(t, model, 1))))
            yield pd.DataFrame(rows, columns=["id", "pool", "text", "restored"])

    return run, f"id {id_type}, pool string, text string, restored string"


def _corrections(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of repaired texts less those of the texts as they stand."""
    more: Counter = Counter()
    less: Counter = Counter()
    for pdf in batches:
        for t, r in zip(pdf["text"], pdf["restored"], strict=True):
            pairs_of(t, less)
            pairs_of(r, more)
    more.subtract(less)
    if more:
        yield pd.DataFrame({"pair": list(more), "n": list(more.values())})


def _rivals(pairs: Broadcast, id_type: str):
    """The chains of each record under the second model."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(pairs.value)
        for pdf in batches:
            rows = []
            for i, s, t in zip(pdf["id"], pdf["pool"], pdf["text"], strict=True):
                d = diagnose(t, model)
                if d:
                    rows.append((i, s, [{"chain": c, "gain": g, "restored": r} for c, g, r in d]))
            yield pd.DataFrame(rows, columns=["id", "pool", "rivals"])

    return run, f"id {id_type}, pool string, rivals array<struct<chain: string, gain: double, restored: string>>"


def _em(pdf: pd.DataFrame) -> pd.DataFrame:
    """Log weights of one source's chains against no damage, from the counts of its records by their chains and gains (in steps of 1)."""
    shown = [([(c, math.exp(g)) for c, g in zip(cs, gs, strict=True)], n) for cs, gs, n in zip(pdf["chains"], pdf["steps"], pdf["n"], strict=True)]
    clean = float(pdf["total"].iloc[0]) - float(pdf["n"].sum())
    chains = {c for s, _ in shown for c, _ in s}
    first = math.exp(PRIOR)
    # A layer more is as rare as damage itself, whatever the source's weights: a longer chain must gain that much more.
    layer = {c: math.exp(PRIOR * c.count(" < ")) for c in chains}
    w = dict.fromkeys(chains, first)
    none = 1.0 - min(0.5, sum(w.values()))
    for _ in range(ROUNDS):
        got, rest = dict.fromkeys(chains, first), clean + 1.0
        for s, n in shown:
            z = none + sum(w[c] * layer[c] * e for c, e in s)
            for c, e in s:
                got[c] += n * w[c] * layer[c] * e / z
            rest += n * none / z
        total = rest + sum(got.values())
        w, none = {c: x / total for c, x in got.items()}, rest / total
    return pd.DataFrame({"pool": pdf["pool"].iloc[0], "chain": list(w), "odds": [math.log(x * layer[c] / none) for c, x in w.items()]})


def repair(df: DataFrame, id_col: str, text: str, source: str) -> DataFrame:
    """(id, source, chain, posterior, restored) of the damaged records; restored is the whole text, "" where characters are lost."""
    sc, kind = df.sparkSession.sparkContext, dict(df.dtypes)[id_col]
    origin = df[source].cast("string")
    pool = F.when(origin.isNull(), "").otherwise(F.concat(F.lit("="), origin))
    rows = df.select(df[id_col].alias("id"), pool.alias("pool"), df[text].alias("text"))
    odd = rows.filter(F.col("text").rlike(r"[^\x00-\x7F]"))
    pairs = character_model(odd.select("text"))
    looked = staged(odd.mapInPandas(*_looked(sc.broadcast(pairs), kind)), "looked")
    # The characters' model is estimated again from the texts as the first model repairs them; only records that showed a trace are judged again.
    repaired = looked.filter("restored is not null").select("text", "restored")
    change = repaired.mapInPandas(_corrections, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).filter("n <> 0")
    pairs = dict(pairs)
    for r in change.collect():
        pairs[r.pair] = max(0, pairs.get(r.pair, 0) + r.n)
    evidence = staged(looked.select("id", "pool", "text").mapInPandas(*_rivals(sc.broadcast(pairs), kind)), "evidence")
    sizes = rows.groupBy("pool").agg(F.count(F.lit(1)).alias("total"))
    # Gains count up to 60 for the best chain; those of its rivals keep their distance from it.
    beyond = F.greatest(F.get("rivals", F.lit(0))["gain"] - 60, F.lit(0.0))
    step = F.transform("rivals", lambda r: F.floor(r["gain"] - beyond).cast("double"))
    pools = evidence.groupBy("pool", F.transform("rivals", lambda r: r["chain"]).alias("chains"), step.alias("steps")).agg(F.count(F.lit(1)).alias("n")).join(sizes, "pool")
    odds = pools.groupBy("pool").applyInPandas(_em, "pool string, chain string, odds double")
    odds = odds.groupBy("pool").agg(F.map_from_entries(F.collect_list(F.struct("chain", "odds"))).alias("odds"))
    heavy = heavy_keys(evidence.groupBy("pool").agg(F.count(F.lit(1)).alias("n")), evidence.count())
    j = split_join(evidence, odds, ["pool"], heavy)
    weigh = lambda r, k: F.struct((r["gain"] - beyond + F.try_element_at("odds", r["chain"])).alias("s"), (-k).alias("k"), r["chain"].alias("chain"), r["restored"].alias("restored"))
    j = j.withColumn("c", F.transform("rivals", weigh)).withColumn("best", F.array_max("c"))
    j = j.withColumn("z", F.aggregate("c", F.lit(0.0), lambda a, r: a + F.exp(r["s"])))
    # Chains that give one text speak for it together.
    same = F.aggregate(F.filter("c", lambda r: r["restored"] == F.col("best.restored")), F.lit(0.0), lambda a, r: a + F.exp(r["s"]))
    damaged, chosen = F.col("z") / (1 + F.col("z")), same / (1 + F.col("z"))
    origin = F.when(F.col("pool") != "", F.substring("pool", 2, 1_000_000))
    return j.filter(damaged >= 0.5).select("id", origin.alias("source"), "best.chain", chosen.alias("posterior"), "best.restored")
