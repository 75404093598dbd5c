"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.functions.url import bare as url_bare

# Stop words, entity names that are none, section titles of methods.
STOP_WORDS = [
    "a", "able", "about", "across", "after", "all", "almost", "also", "am", "among", "an", "and", "any", "are", "as", "at", "be", "because", "been",
    "but", "by", "can", "cannot", "could", "dear", "did", "do", "does", "either", "else", "ever", "every", "for", "from", "get", "got", "had", "has",
    "have", "he", "her", "hers", "him", "his", "how", "however", "i", "if", "in", "into", "is", "it", "its", "just", "least", "let", "like", "likely",
    "may", "me", "might", "most", "must", "my", "neither", "no", "nor", "not", "of", "off", "often", "on", "only", "or", "other", "our", "own",
    "rather", "said", "say", "says", "she", "should", "since", "so", "some", "than", "that", "the", "their", "them", "then", "there", "these", "they",
    "this", "tis", "to", "too", "twas", "us", "wants", "was", "we", "were", "what", "when", "where", "which", "while", "who", "whom", "why", "will",
    "with", "would", "yet", "you", "your",
]
NOISE_ENTITIES = ["program", "programs", "code", "libraries", "interface", "using", "Biomedical"]
METHODS_PATTERN = r"^techniques$|method|procedure|experiment"
TOKEN_PATTERN = r"(\p{L}[\p{L}\p{P}]+\p{L})"
SPAN_PATTERN = r'<span.+?data-nif="([^"]+)'


def count_char(c: Column, ch: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def collapse_lines(c: Column) -> Column:
    """Runs of blanks and tabs to one blank, blank lines away."""
    s = F.regexp_replace(c, "[  \\t]{2,}", " ")
    s = F.regexp_replace(s, "(?:  \\n)+", "\n")
    return F.regexp_replace(s, r"\n{2,}", "\n")


def collapse_space(c: Column) -> Column:
    """Every run of white space, control characters and separators to one blank."""
    return F.regexp_replace(c, r"[\p{Z}\s\x00-\x1F\x7F-\u009F]+", " ")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def drop_supplementary(c: Column, strict: bool = False) -> Column:
    """Without characters beyond the basic plane; strict also drops hyphens and the private part of the basic plane, as old data has it."""
    return F.regexp_replace(c, r"[\x{10000}-\x{10FFFF}]" if not strict else r"[\x{E000}-\x{10FFFF}-]", "")


def file_name(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9._-]", "_")


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def similar_titles(ref: Column, other: Column, part: float = 0.1) -> Column:
    """Equal, one the beginning of the other, or an edit distance of at most that part of the reference, ignoring case."""
    a, b = F.lower(ref), F.lower(other)
    near = F.levenshtein(a, b) / F.when(F.length(a) > 0, F.length(a)) <= part
    return (a == b) | a.startswith(b) | b.startswith(a) | F.coalesce(near, F.lit(False))


def search_terms(name: Column, url: Column, synonyms: Column) -> Column:
    """Terms to search a resource by: name, bare address, name before a colon or dash, synonyms before a colon; the first of equal ones is kept."""
    bare = F.regexp_replace(F.regexp_replace(url_bare(url), r"^https?://", ""), "/$", "")
    short = F.when(F.instr(name, ":") > 0, F.substring_index(name, ":", 1)).when(F.instr(name, "-") > 0, F.substring_index(name, "-", 1))
    others = F.transform(F.split(F.coalesce(synonyms, F.lit("")), ","), lambda s: url_bare(F.substring_index(s, ":", 1)))
    terms = F.concat(F.array(url_bare(name), bare, url_bare(short)), others)
    return F.array_distinct(F.filter(terms, lambda t: t.isNotNull() & (t != "")))


def at_word(term: Column, text: Column) -> Column:
    """Whether the first occurrence of term in text starts a word and ends one, or a digit follows."""
    at = F.instr(text, term)
    before = F.substr(text, at - 1, F.lit(1))
    after = F.substr(text, at + F.length(term), F.lit(1))
    return (at > 0) & ((at == 1) | before.rlike(r"\s")) & ((after == "") | after.rlike(r"[\s0-9]"))


def clean_expansion(c: Column) -> Column:
    """Without a leading preposition and a last word of one symbol."""
    s = F.trim(F.regexp_replace(c, r"^(in|of|for|to|and|from) ", ""))
    return F.regexp_replace(s, r" [^\p{L}]$", "")


def bad_acronym(acronym: Column, expansion: Column) -> Column:
    one = (F.length(acronym) == 1) & acronym.rlike(r"[0-9\p{Ll}]")
    return (F.length(expansion) <= F.length(acronym)) | one


def is_noise(c: Column) -> Column:
    """Entity names of three letters or fewer, of digits and dots alone, or known to be none."""
    return (F.length(c) <= 3) | c.rlike(r"^[0-9.]*$") | c.isin(*NOISE_ENTITIES)


def eligible_section(title: Column) -> Column:
    return F.lower(F.trim(title)).rlike(METHODS_PATTERN)


def tokens(c: Column) -> Column:
    """Words of letters with inner punctuation, in lower case, without stop words."""
    words = F.transform(F.regexp_extract_all(c, F.lit(TOKEN_PATTERN), F.lit(1)), F.lower)
    return F.filter(words, lambda w: ~w.isin(*STOP_WORDS))


def bigrams(words: Column) -> Column:
    n = F.size(words)
    return F.when(n >= 2, F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))


def plain_words(c: Column) -> Column:
    return F.filter(F.split(F.lower(F.trim(c)), r"\s+"), lambda w: w != "")


def content_bigrams(c: Column) -> Column:
    """Pairs of neighbouring words, none a stop word, with no punctuation between."""
    words = plain_words(c)
    n = F.size(words)
    pairs = F.when(n >= 2, F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).otherwise(F.expr("array()").cast("array<struct<a:string,b:string>>"))
    bare = lambda w: F.regexp_replace(w, r"[.,;:?!]$", "")
    good = F.filter(pairs, lambda p: ~p["a"].rlike(r"[.,;:?!]$") & ~p["a"].isin(*STOP_WORDS) & ~bare(p["b"]).isin(*STOP_WORDS))
    return F.transform(good, lambda p: F.concat_ws(" ", p["a"], bare(p["b"])))


def span_categories(c: Column) -> Column:
    """Categories of annotated spans."""
    return F.regexp_extract_all(c, F.lit(SPAN_PATTERN), F.lit(1))


def _runs(c: Column, k: int) -> Column:
    """Runs of k words in lower case as structs; the words aren't looked at again for each run."""
    words = plain_words(c)
    m = F.greatest(F.size(words) - (k - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(words, F.lit(j), m) for j in range(1, k + 1)])


def shingles(c: Column, k: int) -> Column:
    """Distinct runs of k words in lower case, each word followed by a bar."""
    return F.array_distinct(F.transform(_runs(c, k), lambda s: F.concat(*[x for j in range(k) for x in (s[str(j)], F.lit("|"))])))


def shingle_hashes(c: Column, k: int) -> Column:
    """shingles as 64-bit hashes, for sets of which only sizes count: sets of numbers are hashed, those of strings aren't."""
    return F.array_distinct(F.transform(_runs(c, k), lambda s: F.xxhash64(s)))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def containment(a: Column, b: Column) -> Column:
    """Share of a that lies in b."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def split_period(tokens: Column) -> Column:
    """Tokens without a single full stop at their end."""
    return F.transform(tokens, lambda x: F.regexp_replace(x, r"(?<=[^.])\.$", ""))
