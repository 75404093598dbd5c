"""URL functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What an address is in running text, substrings and media types of addresses that are no resource.
URL_PATTERN = r"((([A-Za-z]{3,9}:(?://)?)(?:[-;:&=\+\$,\w]+@)?[A-Za-z0-9.-]+|(?:www.|[-;:&=\+\$,\w]+@)[A-Za-z0-9.-]+)((?:/[\+~%/.\w_-]*)?\??(?:[-\+=&;%@.\w_]*)#?(?:[\w]*))?)"
MENTION_PATTERN = r'(http.+?)((\.\s)|"|<|\s|\(|\)|\[|\])'
# The same at the end of a text as well, and hosts of three labels without a scheme.
TEXT_PATTERN = r'(http.+?)(?:\.\s|"|<|\s|\(|\)|\[|\]|\.?$)'
BARE_PATTERN = r'\s(\w+?\.\w+?\.\w{3})(?:\.\s|"|<|\s|\(|\)|\[|\]|\.?$)'
BAD_PARTS = ["www.w3.org", "creativecommons", "dx.doi", "www.elsevier.com"]
MEDIA_PATTERN = r"(?i)zip|rar|gz|jpg|jpeg|gif|bz2|pdf"
PAGE_MEDIA_PATTERN = r"(?i)\.(pdf|jpg|gif|bmp|ppt|doc)$"
VALID_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*:.+"
SUPPLEMENT_PATTERN = r"(?i)suppl?"


def bare(c: Column) -> Column:
    """Without white space and control characters at the ends."""
    return F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def registry_form(c: Column) -> Column:
    """Trimmed, lower case, one trailing slash dropped, a scheme in front."""
    s = F.regexp_replace(F.lower(bare(c)), "/$", "")
    return F.when(s.startswith("http"), s).otherwise(F.concat(F.lit("http://"), s))


def registry_forms(c: Column) -> Column:
    """Each entry of a comma-separated list in registry form."""
    return F.transform(F.split(bare(c), r"\s*,\s*"), registry_form)


def extraction_form(c: Column) -> Column:
    """Trimmed, without a trailing slash, then without one trailing full stop; case is kept."""
    return bare(F.regexp_replace(F.regexp_replace(bare(c), "/$", ""), r"\.$", ""))


def host_form(c: Column) -> Column:
    """Without http://, trailing slash and leading www."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "^http://", ""), "/$", ""), r"^www\.", "")


def first_url(c: Column) -> Column:
    u = F.regexp_extract(c, URL_PATTERN, 1)
    return F.when(u != "", u)


def mentions(c: Column) -> Column:
    """The addresses in a running text that something ends, as an array; one that ends with the text isn't among them (see text_addresses)."""
    return F.regexp_extract_all(c, F.lit(MENTION_PATTERN), F.lit(1))


def text_addresses(c: Column) -> Column:
    """All addresses in a running text in extraction form, as an array: those with a scheme, then bare hosts; the text's end ends one, too."""
    found = [F.regexp_extract_all(c, F.lit(p), F.lit(1)) for p in (TEXT_PATTERN, BARE_PATTERN)]
    return F.transform(F.concat(*found), extraction_form)


def host(c: Column) -> Column:
    """Host in lower case, or null."""
    h = F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))
    return F.when(h != "", h)


def path(c: Column) -> Column:
    return F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query(c: Column) -> Column:
    q = F.regexp_extract(c, r"^[^?#]*\?([^#]*)", 1)
    return F.when(q != "", q)


def base(c: Column) -> Column:
    """Scheme, host and path, without query and fragment."""
    return F.regexp_extract(c, r"^[^?#]*", 0)


def top_level_domain(c: Column) -> Column:
    """Last label of a host that has several."""
    return F.when(F.instr(c, ".") > 0, F.element_at(F.split(c, "[.]"), -1))


def is_bad(c: Column) -> Column:
    """No resource: known parts, media types, mail addresses, or not an address at all."""
    known = F.lit(False)
    for part in BAD_PARTS:
        known = known | c.contains(part)
    return known | c.rlike(MEDIA_PATTERN) | c.startswith("mail") | ~c.rlike(VALID_PATTERN)


def variants(c: Column) -> Column:
    """Array of (priority, variant) of an address in registry form: itself, without or with www., with an index page."""
    stripped = F.when(c.startswith("http://www."), F.concat(F.lit("http://"), F.substr(c, F.lit(12))))
    dots = F.length(c) - F.length(F.replace(c, F.lit("."), F.lit("")))
    added = F.when(~c.startswith("http://www.") & (dots == 1), F.concat(F.lit("http://www."), F.substr(c, F.lit(8))))
    index = F.when(c.endswith("/index.html"), F.lit(None)).otherwise(F.concat(c, F.lit("/index.html")))
    all_ = F.array(*[F.struct(F.lit(k).alias("priority"), v.alias("variant")) for k, v in enumerate((c, stripped, added, index))])
    return F.filter(all_, lambda v: v["variant"].isNotNull())


def resolve(link: Column, page: Column) -> Column:
    """A link of a page as an absolute address."""
    root = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_extract(page, r"^[^?#]*", 0), r"(//[^/]*.*)/[^/]*$", "$1")
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(folder, F.lit("/"), F.regexp_replace(link, r"^\./", "")))
    )


def redirects_away(original: Column, target: Column) -> Column:
    """Whether a redirect leads to another page than the same one with or without www., scheme or trailing slash."""
    form = lambda c: F.regexp_replace(F.regexp_replace(F.lower(c), r"^https?://(www\.)?", ""), "/$", "")
    return target.isNotNull() & (form(original) != form(target))
