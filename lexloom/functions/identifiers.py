"""Identifiers of acts: parsed into their parts, built from them, and turned into one another."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The forms of the identifiers.  Groups: place, kind, year, number; 0 where a form has none.
FORMS: list[tuple[str, str, tuple[int, int, int, int]]] = [
    ("celex", r"^[0-9CE](\d{4})([A-Z]{1,2})(\d{4})(?:-\d{8})?$", (0, 2, 1, 3)),
    ("gazette", r"^([A-Z]{3,5})-([A-Z])-(\d{4})-(\d+)$", (1, 2, 3, 4)),
    ("urn", r"^urn:(?:lex|nir):([a-z:.]+?):([a-z.]+):(\d{4})(?:-\d{2}-\d{2})?;([\w-]+)", (1, 2, 3, 4)),
    ("eli", r"(?:^|/)eli/(?:([a-z]{2}(?:-[a-z]{2,3})?)/)?([a-z][a-z.-]*)/(\d{4})/(?:\d{1,2}/\d{1,2}/)?([\w.-]+)", (1, 2, 3, 4)),
    ("statute", r"^(?:https?://[^/]+/)?(?:id/)?(ukpga|ukla|uksi|asp|asc|nia|nisr|ssi|wsi|anaw|mwa|ukcm)/(\d{4})/(\d+)", (0, 1, 2, 3)),
    ("journal", r"^(DU|MP)/(\d{4})/(\d+)$", (0, 1, 2, 3)),
    ("code", r"^/([a-z]{2})/(usc)/t(\w+)(?:/s(\w+))?$", (1, 2, 0, 3)),
    ("register", r"^(BWB[RV])(\d{7})$", (0, 1, 0, 2)),
    ("yearly", r"^(?:SFS\s+)?(\d{4}):(\d+)$", (0, 0, 1, 2)),
]
PARTS = ("place", "kind", "year", "number")


def parsed(text: Column) -> Column:
    """scheme, place, kind, year and number of an identifier; all null for what has no known form."""
    trimmed = F.trim(text)

    def of(pattern: str, groups: tuple[int, int, int, int]) -> list[Column]:
        return [F.nullif(F.regexp_extract(trimmed, pattern, g), F.lit("")).alias(p) if g else F.lit(None).cast("string").alias(p) for p, g in zip(PARTS, groups, strict=True)]

    kind = "struct<scheme:string,place:string,kind:string,year:string,number:string>"
    out = F.lit(None).cast(kind)
    for scheme, pattern, groups in reversed(FORMS):
        out = F.when(trimmed.rlike(pattern), F.struct(F.lit(scheme).alias("scheme"), *of(pattern, groups)).cast(kind)).otherwise(out)
    return out


def built(scheme: str, place: Column | None = None, kind: Column | None = None, year: Column | None = None, number: Column | None = None) -> Column:
    """The identifier of a scheme; null if a part that it needs is."""
    text = lambda x: F.lit(None).cast("string") if x is None else x.cast("string")
    p, k, y, n = map(text, (place, kind, year, number))
    if scheme == "celex":
        return F.concat(F.lit("3"), y, k, F.lpad(n, 4, "0"))
    if scheme == "gazette":
        return F.concat(p, F.lit("-"), k, F.lit("-"), y, F.lit("-"), n)
    if scheme == "eli":
        return F.concat(F.lit("/eli/"), F.coalesce(F.concat(p, F.lit("/")), F.lit("")), k, F.lit("/"), y, F.lit("/"), n)
    if scheme == "urn":
        return F.concat(F.lit("urn:nir:"), p, F.lit(":"), k, F.lit(":"), y, F.lit(";"), n)
    if scheme in ("statute", "journal"):
        return F.concat(k, F.lit("/"), y, F.lit("/"), n)
    if scheme == "register":
        return F.concat(k, F.lpad(n, 7, "0"))
    if scheme == "yearly":
        return F.concat(y, F.lit(":"), n)
    raise ValueError(f"nothing is built by the scheme {scheme}")


_SECTION = r"\d+(?:\s[a-z]\b)?"
_SPANS = rf"{_SECTION}(?:\s*(?:,|och|[-–])\s*{_SECTION})*"


def affected_sections(note: Column) -> Column:
    """The sections that a register's note names: "ändr. 1 kap. 3, 5-7 §§; ny 8 a §" gives 1:3, 1:5, 1:6, 1:7 and 8 a."""
    def sections(match: Column) -> Column:
        chapter = F.regexp_extract(match, rf"^({_SECTION})\s*kap", 1)
        listed = F.split(F.regexp_replace(match, rf"^{_SECTION}\s*kap\.\s*|\s*§+\s*$", ""), r"\s*(?:,|och)\s*")

        def numbers(item: Column) -> Column:
            low, high = F.regexp_extract(item, r"^(\d+)\s*[-–]\s*\d+$", 1), F.regexp_extract(item, r"^\d+\s*[-–]\s*(\d+)$", 1)
            run = F.transform(F.sequence(F.try_to_number(F.when(high != "", low).otherwise("1"), F.lit("99999")).cast("int"), F.try_to_number(F.when(high != "", high).otherwise("1"), F.lit("99999")).cast("int")), lambda n: n.cast("string"))
            return F.when(high != "", run).otherwise(F.array(F.trim(item)))

        return F.transform(F.flatten(F.transform(listed, numbers)), lambda s: F.when(chapter != "", F.concat(chapter, F.lit(":"), s)).otherwise(s))

    return F.flatten(F.transform(F.regexp_extract_all(F.coalesce(note, F.lit("")), F.lit(rf"(?:{_SECTION}\s*kap\.\s*)?{_SPANS}\s*§"), 0), sections))


def short_title(title: Column, most: int = 120) -> Column:
    """A title one can cite: the name it gives itself in brackets, or what comes before its first turn of phrase.

    Remarks on its scope go; a title that is still too long ends at a word, with an ellipsis.
    """
    bare = F.trim(F.regexp_replace(title, r"(?i)\s*\(?text with eea relevance\)?\s*", " "))
    own = F.regexp_extract(bare, r"\(([^()]*\b(?:Act|Regulation|Directive|Code|Law|Ley|Loi|Gesetz|Lag)\b[^()]*)\)\s*\.?$", 1)
    cut = F.regexp_replace(bare, r"(?i),?\s+(?:of the european parliament|concerning|relating to|por (?:el|la) que|por (?:los|las) que|relatif à|relative à|om ändring i).*$", "")
    kept = F.rtrim(F.when(own != "", own).when(F.length(cut) >= 3, cut).otherwise(bare), F.lit(". "))
    return F.when(F.length(kept) <= most, kept).otherwise(F.concat(F.regexp_extract(kept, rf"^(.{{1,{most - 1}}})\s", 1), F.lit("…")))
