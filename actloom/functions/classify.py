"""Classifiers of legal text lines as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from actloom.functions.text import QUOTE, clean, clean_markup, is_bare_marker, let, unquoted, without_roman

#: classes of the legal page layout (fixed values)
LEGAL = ("eli-container", "eli-main-title", "eli-title", "eli-subdivision", "oj-doc-ti", "oj-hd-ti", "oj-hd-date", "oj-hd-lg", "oj-hd-oj", "oj-ti-art", "oj-sti-art", "oj-ti-section-1", "oj-ti-section-2", "oj-normal", "oj-enumeration-spacing", "oj-doc-end", "oj-doc-sep", "oj-final", "oj-signatory")
TABLE = ("oj-table", "oj-tbl-hdr", "oj-tbl-txt", "oj-ti-tbl")
NOTE = ("oj-note", "oj-note-tag", "oj-super")
NAVIGATION = ("Wrapper", "affix-top", "clearfix", "col-md-3", "col-md-9", "collapse", "container-fluid", "fa", "fa-angle-right", "fa-times", "nav", "row", "row-offcanvas", "toc-eli-label", "toc-eli-subdivisions", "toc-sidebar", "toc-sidenav", "tocWrapper")
SMALL_ROMANS = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii", "xiii", "xiv", "xv")
ANNEX_START = r"(?iU)^\s*ANNEX\s+([IVXLCDM]+|\d+)?\b"

#: phrases of amending instructions and keys of QA reports (fixed values)
_THING = r"(?:paragraph|point|article|subparagraph)s?"
INSTRUCTION = "|".join(
    (
        r"\bis amended as follows\b",
        rf"\bthe following {_THING} (?:is|are) (?:inserted|added)\b",
        r"\bin the (?:first|second) subparagraph, the following sentence is added\b",
        r"\bin the second subparagraph, the following subparagraphs? are added\b",
        r"\b(?:is|are) inserted as annex\s+[a-z0-9]+\b",
        r"\bannexes?\s+[ivxlcdm0-9\s,toand]+\s+are\s+amended\s+in\s+accordance\s+with\s+the\s+annex\s+to\s+this\s+regulation\b",
        r"\b(?:is|are) replaced by the following\b",
        r"\b(?:is|are) deleted\b",
    )
)
#: one of these stands in every text that holds a phrase above (fixed values)
SAYS = ("follow", "inserted as annex", "in accordance", "deleted")
REPORT_KEY = r'(?i)"(?:missing_unique_tokens|missing_tokens|coverage_ratio|comparison_type|report_type|source_docx|source_html|token_coverage)"\s*:'


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, or null."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def has_any(classes: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(F.arrays_overlap(classes, F.array(*map(F.lit, names))), F.lit(False))


def is_navigation(classes: Column) -> Column:
    return has_any(classes, NAVIGATION)


def is_legal_element(classes: Column) -> Column:
    return ~is_navigation(classes) & has_any(classes, LEGAL + TABLE + NOTE)


def is_emitted(classes: Column) -> Column:
    return ~has_any(classes, ("eli-subdivision",))


def is_section_heading(classes: Column, text: Column) -> Column:
    return ~has_any(classes, ("oj-ti-art", "oj-sti-art")) & ~text.rlike(ANNEX_START) & has_any(classes, ("eli-title", "oj-ti-section-1", "oj-ti-section-2", "oj-doc-ti"))


def section_level(classes: Column) -> Column:
    one = lambda c: has_any(classes, (c,))
    return F.when(one("eli-title"), 1).when(one("oj-ti-section-1"), 2).when(one("oj-ti-section-2"), 3).when(one("oj-doc-ti"), 1).otherwise(9)


def is_annex_heading(classes: Column, text: Column) -> Column:
    kinds = ("oj-doc-ti", "eli-title", "oj-ti-section-1", "oj-ti-section-2", "oj-normal", "oj-hd-ti", "eli-subdivision")
    return ~is_navigation(classes) & text.rlike(ANNEX_START) & has_any(classes, kinds)


def block_role(text: Column, classes: Column) -> Column:
    t = clean_markup(text)
    return (
        F.when(t.rlike(r"(?U)^\s*\d+\.\s+"), "article_paragraph")
        .when(t.rlike(r"(?iU)^\s*\(?[a-z]\)\s+"), "point")
        .when(t.rlike(r"(?iU)^\s*\(?[ivxlcdm]+\)\s+"), "subpoint")
        .when(has_any(classes, ("oj-enumeration-spacing",)), "enumeration")
        .when(has_any(classes, ("oj-final",)), "final")
        .when(has_any(classes, ("oj-signatory",)), "signatory")
        .otherwise("paragraph")
    )


def marker_type(text: Column) -> Column:
    t = clean(text)
    return (
        F.when(t.rlike(r"^\d+\."), "digit")
        .when(t.rlike(r"^\([a-z]\)"), "letter")
        .when(t.rlike(r"(?i)^\([ivxlcdm]+\)"), "roman")
        .when(t.rlike("^[—–]"), "dash")
        .when(t.rlike(r"^[A-Z]\."), "annex-letter")
        .when(t.rlike(r"(?i)^[ivxlcdm]+\."), "annex-roman")
    )


def paragraph_level(text: Column) -> Column:
    """Indentation level from the text alone: digits 1, letters 2, romans and dashes 3, annex markers 1, else 0."""
    k = marker_type(text)
    return F.when(k.isin("digit", "annex-letter", "annex-roman"), 1).when(k == "letter", 2).when(k.isin("roman", "dash"), 3).otherwise(0)


def is_standalone_marker(text: Column) -> Column:
    return clean(text).rlike(r"(?i)^(?:\([ivxlcdm]+\)|\([a-z]\)|[a-z]\.|[ivxlcdm]+\.|—|–)$")


def is_instruction(text: Column) -> Column:
    def says(t: Column) -> Column:
        # plain searches first: few texts are instructions, and the phrases are slow to look for
        some = F.contains(t, F.lit(SAYS[0]))
        for w in SAYS[1:]:
            some = some | F.contains(t, F.lit(w))
        return F.when(some, t.rlike(INSTRUCTION)).otherwise(F.lit(False)) | t.rlike(r"^\(\d+\)$")

    return let(F.lower(without_roman(text)), says)


def amendment_kind(instruction: Column, text: Column) -> Column:
    return let(F.struct(F.lower(clean(instruction)).alias("i"), is_bare_marker(text).alias("bare")), lambda v: _kind(v["i"], v["bare"]))


def _kind(i: Column, bare: Column) -> Column:
    return (
        F.when(i == "", "insertion")
        .when(i.rlike(r"\breplaced\s+by\s+the\s+following\b|\b(?:is|are)\s+replaced\b"), "replacement")
        .when(i.rlike(r"\bdeleted\b"), "deletion")
        .when(i.rlike(r"\b(?:is|are)\s+inserted\s+as\s+annex\b"), "insertion")
        .when(i.rlike(rf"\bthe following {_THING}\s+(?:is|are)\s+(?:inserted|added)\b|\bthe following sentence is added\b"), "insertion")
        .when(bare, "structural")
        .otherwise("insertion")
    )


def is_report_fragment(text: Column) -> Column:
    """Text that is a piece of a QA report and no law."""
    t = clean(text)
    quoted = t.rlike(r"^[\[{]") & t.rlike(r'"[^"\\n]+"\s*:\s*')
    many = t.rlike(r"[{\[]") & (F.size(F.split(t, '":')) > 2)
    return (t != "") & (t.rlike(REPORT_KEY) | F.lower(t).startswith('"missing_unique_tokens"') | quoted | many)


def is_relevant(heading: Column, instruction: Column, target: Column) -> Column:
    """Whether an item amends the target act; without a target all do."""
    needle = F.lower(target)
    return F.coalesce(target, F.lit("")).isin("") | F.contains(F.lower(clean(heading)), needle) | F.contains(F.lower(clean(instruction)), needle)


def is_small_roman(marker: Column) -> Column:
    return F.coalesce(F.lower(marker).isin(*SMALL_ROMANS), F.lit(False))


def _naming(text: Column, word: str, value: Column) -> Column:
    """What is found behind a word, searched only in texts that hold it: most lines do not, and cleaning costs more."""
    return F.when(F.contains(F.lower(text), F.lit(word)), value)


def article_number(text: Column) -> Column:
    return _naming(text, "article", found(clean(text), r"(?i)^Article\s+(\d+[A-Za-z]?)\b"))


def annex_number(text: Column) -> Column:
    return F.upper(found(clean(text), r"(?i)^ANNEX\s+([IVXLC]+)\b"))


def chapter_number(text: Column) -> Column:
    return _naming(text, "chapter", F.upper(found(clean(text), r"(?i)^CHAPTER\s+([IVXLC]+)\b")))


def annex_label(text: Column) -> Column:
    return _naming(text, "annex", F.upper(found(unquoted(clean(text)), r"(?i)^ANNEX\s+([IVXLC]+[A-Za-z]?)\b")))


def annex_heading_and_title(text: Column) -> Column:
    """(heading, title) of a line that holds both, else nulls."""
    p = r"(?i)^(ANNEX [IVXLC]+[A-Za-z]?) (.+)$"
    return F.struct(found(clean(text), p, 1).alias("heading"), found(clean(text), p, 2).alias("title"))


def is_hard_boundary(text: Column) -> Column:
    return clean(text).rlike(r"(?i)^(?:CHAPTER|ANNEX)\b")


def paragraph_marker(text: Column) -> Column:
    return found(clean(text), rf"^[{QUOTE}]?(\d+[A-Za-z]?)\.")


def spaced_paragraph_marker(text: Column) -> Column:
    """The audit's stricter form: whitespace or the end follows the stop; lower case."""
    return F.lower(found(clean(text), rf"^[{QUOTE}]?(\d+[A-Za-z]?)\.(?=\s|$)"))


def point_marker(text: Column) -> Column:
    return F.lower(found(clean(text), r"(?i)^\(([a-z]+)\)"))


def inner_point_marker(text: Column) -> Column:
    """The point behind an optional leading roman, as target matching reads it."""
    return F.lower(found(clean(text), r"(?i)^\([ivxlcdm]+\) \(([a-z]+)\)"))


def is_point(text: Column, marker: Column) -> Column:
    m = F.lower(marker)
    return F.coalesce((point_marker(text) == m) | (inner_point_marker(text) == m), F.lit(False))


def annex_point(text: Column) -> Column:
    return F.upper(found(clean(text), rf"(?i)^[{QUOTE}]?([IVXLC]+)\.(?=\s|$)"))


def sort_key(marker: Column) -> Column:
    """(number, suffix) order of paragraph markers; what is no marker comes last."""
    m = F.trim(marker)
    n = found(m, r"^(\d+)[A-Za-z]*$")
    return F.when(n.isNotNull(), F.struct(n.cast("bigint").alias("n"), F.lower(F.regexp_extract(m, r"^\d+([A-Za-z]*)$", 1)).alias("s"))).otherwise(F.struct(F.lit(10**9).cast("bigint").alias("n"), F.lower(marker).alias("s")))


def split_number(marker: Column) -> Column:
    m = F.trim(F.coalesce(marker, F.lit("")))
    n = found(m, r"^(\d+)[A-Za-z]*$")
    return F.struct(F.coalesce(n, marker).alias("number"), F.when(n.isNotNull(), F.regexp_extract(m, r"^\d+([A-Za-z]*)$", 1)).otherwise("").alias("suffix"))


def has_inserted_style(runs: Column) -> Column:
    return F.exists(runs, lambda r: r["double_underline"] & ~r["strike"])


def effective_text(runs: Column) -> Column:
    """The text that stands after revision: runs that are not struck."""
    return clean(F.array_join(F.transform(F.filter(runs, lambda r: ~F.coalesce(r["strike"], F.lit(False))), lambda r: r["text"]), ""))
