"""Text cleaning, escaping, formatting and extraction as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accented Latin letters and the plain ones they fold to.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"
DIGITS, SUPERSCRIPT, SUBSCRIPT = "0123456789+-=()", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾", "₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎"


def clean(text: Column) -> Column:
    """No control characters, no-break and zero-width spaces normalised, ends trimmed."""
    bare = F.regexp_replace(text, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]", "")
    return F.trim(F.translate(F.translate(bare, "\u00a0\u2007\u202f", "   "), "\u200b\u200c\u200d\ufeff", ""))


def squeeze_lines(text: Column) -> Column:
    """Runs of blanks become one, but in lines of a table or a fence."""
    line = lambda x: F.when(x.startswith("|") | x.startswith("```"), x).otherwise(F.regexp_replace(x, "[ \t]+", " "))
    return F.array_join(F.transform(F.split(text, "\n", -1), line), "\n")


def yaml_quoted(text: Column) -> Column:
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t")), F.lit('"'))


def title(text: Column) -> Column:
    """Without the dots and blanks at the end."""
    return F.regexp_replace(text, "[. ]+$", "")


def escape_numbering(line: Column) -> Column:
    """A number that opens a line is no list marker."""
    return F.regexp_replace(line, "^([0-9]{1,9})([.)])([ \t])", "$1\\\\$2$3")


def wrapped(text: Column, mark: str) -> Column:
    """Markup around the text, with outer blanks left outside."""
    inner = F.trim(text)
    lead, tail = F.regexp_extract(text, "^( *)", 1), F.regexp_extract(text, "( *)$", 1)
    return F.when(inner == "", text).otherwise(F.concat(lead, F.lit(mark), inner, F.lit(mark), tail))


def normalised(value: Column) -> Column:
    """For comparing values: blanks squeezed, lower case, a timestamp cut to its day."""
    text = F.lower(F.trim(F.regexp_replace(value, "[ \t\n]+", " ")))
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}[t ][0-9]{2}:"), F.substring(text, 1, 10)).otherwise(text)


def safe_id(key: Column) -> Column:
    return F.replace(F.translate(key, ":/", "--"), F.lit(" "), F.lit(""))


def folded(text: Column) -> Column:
    return F.translate(text, ACCENTED, PLAIN)


def slug(text: Column, most: int = 60) -> Column:
    dashed = F.regexp_replace(F.lower(folded(text)), "[^a-z0-9]+", "-")
    return F.left(F.regexp_replace(dashed, "^-+|-+$", ""), F.lit(most))


def article_id(label: Column) -> Column:
    return F.concat(F.lit("art"), F.regexp_replace(F.lower(label), "[^a-z0-9]+", ""))


def html_to_text(html: Column) -> Column:
    """Scripts, styles and tags away, the common entities decoded, blanks squeezed."""
    bare = F.regexp_replace(html, "(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    bare = F.regexp_replace(bare, "(?i)<br[^>]*>|</p>|</div>|</li>", "\n")
    bare = F.regexp_replace(bare, "<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    lines = F.regexp_replace(F.regexp_replace(bare, "[ \t]+", " "), " ?\n[ \n]*", "\n")
    return F.regexp_replace(lines, "^[ \n]+|[ \n]+$", "")


def snippet(body: Column, most: int = 300) -> Column:
    bare = F.regexp_replace(F.regexp_replace(body, "(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), "<[^>]*>", " ")
    return F.left(F.trim(F.regexp_replace(bare, "[ \t\r\n]+", " ")), F.lit(most))


def html_to_markdown(html: Column) -> Column:
    """Inline tags become marks."""
    out = F.regexp_replace(html, "(?i)</?(b|strong)>", "**")
    out = F.regexp_replace(out, "(?i)</?(i|em)>", "*")
    out = F.regexp_replace(out, '(?i)<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>', "[$2]($1)")
    return F.regexp_replace(F.regexp_replace(out, "(?i)<br[^>]*>", "\n"), "<[^>]*>", "")


def raised(text: Column) -> Column:
    """Superscript characters, if every character has one; else a caret form."""
    return F.when(text.rlike("^[0-9+=()-]+$"), F.translate(text, DIGITS, SUPERSCRIPT)).otherwise(F.concat(F.lit("^("), text, F.lit(")")))


def tokens(text: Column) -> Column:
    """Words in lower case: runs of letters, marks, digits and underscores of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w+"), 0)


def mojibake(text: Column) -> Column:
    """How many tell-tale pairs of UTF-8 read as Latin-1 the text has."""
    return F.regexp_count(text, F.lit("[\u00c2\u00c3][\u0080-\u00bf]"))


def repaired(text: Column) -> Column:
    return F.when(mojibake(text) > 0, F.decode(F.encode(text, "ISO-8859-1"), "UTF-8")).otherwise(text)


def without_payload(text: Column) -> Column:
    return F.regexp_replace(text, "data:image/[a-z]+;base64,[A-Za-z0-9+/=]+", "")


def first_rule(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The value of the first pattern that matches."""
    out = F.when(text.rlike(rules[0][0]), rules[0][1])
    for pattern, value in rules[1:]:
        out = out.when(text.rlike(pattern), value)
    return out.otherwise(default)


def commit_subject(kind: Column, name: Column, articles: Column) -> Column:
    return F.concat(F.lit("["), kind, F.lit("] "), name, F.when(articles != "", F.concat(F.lit(" — "), articles)).otherwise(""))


def trailers(**values: Column) -> Column:
    """Lines "Key: value" of what is known."""
    return F.concat_ws("\n", *[F.when(v.isNotNull(), F.concat(F.lit(k.replace("_", "-") + ": "), v)) for k, v in values.items()])
