"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin letters with marks and their plain forms.
MARKED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyAAAAAAEEEEIIIIOOOOOUUUUCNY"


def unaccent(c: Column) -> Column:
    """Latin letters without their marks."""
    return F.translate(c, MARKED, PLAIN)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def pad_id(c: Column, width: int = 11) -> Column:
    """Zero-padded on the left; longer ids are cut, as ``lpad`` does."""
    return F.lpad(c.cast("string"), width, "0")


def short_name(c: Column, last: bool = True) -> Column:
    """First and last word of a name, capitalised; the first alone keeps one blank after it."""
    words = F.split(c, " ")
    first = F.get(words, F.lit(0))
    if not last:
        return F.concat(F.initcap(first), F.lit(" "))
    return F.initcap(F.when(F.size(words) > 1, F.concat(first, F.lit(" "), F.element_at(words, -1))).otherwise(c))


def social_or_legal(social: Column, legal: Column) -> Column:
    """The social name unless null or empty."""
    return F.coalesce(F.nullif(social, F.lit("")), legal)


def one_line(c: Column) -> Column:
    return F.regexp_replace(c, r"[\r\n]", "")


def strip_marks(c: Column) -> Column:
    """An id without its nine separator marks."""
    return F.translate(c, "-./() ,+;", "")


def leading_number(c: Column) -> Column:
    """The number that a text with a unit starts with, else null."""
    return F.regexp_extract(c, r"^\s*(-?[0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")


def brl(c: Column) -> Column:
    """``R$ 1,50``: two decimals, a decimal comma."""
    return F.concat(F.lit("R$ "), F.replace(F.format_string("%.2f", c.cast("double")), F.lit("."), F.lit(",")))


def address_key(*parts: Column) -> Column:
    """Lower case, only ASCII letters, digits and blanks; null parts are left out."""
    return F.lower(F.regexp_replace(F.concat_ws(" ", *parts), r"[^a-zA-Z0-9 ]", ""))


# Fixed value: the mark of the feed after which links stand, and its end.
ATTACHED = r"(?is)ANEXOS:\s*(.+?)(?:\s*>>|$)"


def attachment_links(c: Column, direct: Column | None = None) -> Column:
    """Links after ``ANEXOS:`` up to ``>>`` or the end, joined by ``;``; else the direct link, if it is one; else the empty text.

    Links are apart by ``||``, blanks, commas or semicolons. A null text has no links of its own; without a direct link it gives null.
    """
    links = F.filter(F.split(F.regexp_extract(c, ATTACHED, 1), r"\|\||[\s,;]+"), lambda x: x.startswith("http"))
    found = F.array_join(links, ";")
    if direct is None:
        return found
    return F.when(F.size(links) > 0, found).otherwise(F.when(F.trim(direct).startswith("http"), F.trim(direct)).otherwise(""))


def fill(template: str, **values: Column) -> Column:
    """``{name}`` in a template replaced by values; a null value is an empty text."""
    parts, rest = [], template
    while "{" in rest:
        before, _, more = rest.partition("{")
        name, _, rest = more.partition("}")
        parts += [F.lit(before), F.coalesce(values[name].cast("string"), F.lit(""))]
    return F.concat(*parts, F.lit(rest))


def text_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def path_token(c: Column) -> Column:
    """Everything but word characters and hyphens becomes ``_``."""
    return F.regexp_replace(c, r"(?U)[^\w-]", "_")


def year_suffix(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"_([0-9]{4})$", 1), F.lit("")).cast("int")


def classify(c: Column, rules: dict[str, str], default: str | None = None) -> Column:
    """The label of the first pattern found in a text."""
    out = F.lit(default).cast("string")
    for label, pattern in reversed(rules.items()):
        out = F.when(c.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def matches_any(c: Column, keywords: list[str]) -> Column:
    """Whether the trimmed lower-case text holds a keyword."""
    found = F.lit(False)
    for k in keywords:
        found = found | F.lower(F.trim(c)).contains(k)
    return found


def recode(c: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    """A value's label, the default where it has none."""
    out = F.lit(default).cast("string")
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def recode_capped(c: Column, mapping: dict[str, str], n: int) -> Column:
    return F.left(F.coalesce(recode(c, mapping), c), F.lit(n))


def lines_to_json(c: Column) -> Column:
    """A JSON object as it is; else ``key: value`` lines as a JSON object, lines without a colon appended to the line before."""
    joined = F.regexp_replace(c, r"\n(?=[^:\n]*(?:\n|$))", " ")
    pairs = F.filter(F.split(joined, "\n"), lambda x: x.contains(":"))
    entries = F.transform(pairs, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.regexp_replace(x, r"^[^:]*:", "")).alias("value")))
    as_map = F.map_from_entries(_last_by_key(entries))
    return F.when(F.try_parse_json(c).isNotNull() & F.trim(c).startswith("{"), c).otherwise(F.to_json(as_map))


def _last_by_key(entries: Column) -> Column:
    """Entries without those whose key comes again."""
    return F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda x: x["key"] == e["key"]))
