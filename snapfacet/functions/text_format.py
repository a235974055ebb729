"""Flat description text -> sections, lists and paragraphs.

A text is parted into pieces first: boundaries are marked by control characters, then the text is
split at the marks. Its long form is a table (section, item, kind, text); its HTML form is written
from the same pieces, one element per piece, a list around neighbouring items of one kind.

Rules: a header is a short label between wide gaps (two or more spaces) and a colon; a numbered item
is a number with a full stop after the start, a wide gap or ``; or``, in texts that have an item 1; a
bullet starts an item; a gap of three or more spaces ends a paragraph. Pieces without text are
left out. Control characters 1 to 6 of the source are taken as spaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ColumnOrName, col
from .labels import escape_html

# Longest header label, bullets, and white space as browsers define it.
HEADER_CHARS = 30
BULLETS = "·§•"
SPACE = "[\\t-\\r \\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\uFEFF]"

#: The same in texts that have none but ASCII white space: Java tests this class by a table.
ASCII_SPACE = "\\s"
RARE_SPACES = "\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
SPACES = "\t\n\x0b\x0c\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"

SECTION, TITLE_END, NUMBERED, BULLET, PARAGRAPH, CUT = "\x01", "\x02", "\x03", "\x04", "\x05", "\x06"


def _plain(text: Column) -> Column:
    """Whether a text has no white space but ASCII: it is ASCII, or holds none of the others."""
    rare = F.contains(text, F.lit(RARE_SPACES[0]))
    for c in RARE_SPACES[1:]:
        rare = rare | F.contains(text, F.lit(c))
    return (F.octet_length(text) == F.char_length(text)) | ~rare


def _spaced(plain: Column, step):
    """A step by the cheaper class of white space where the text allows it."""
    return F.when(plain, step(ASCII_SPACE)).otherwise(step(SPACE))


def _headed(text: Column, plain: Column) -> Column:
    """The text with a mark around each header's label."""
    clean = F.when(text.rlike(f"[{SECTION}-{CUT}]"), F.translate(text, SECTION + TITLE_END + NUMBERED + BULLET + PARAGRAPH + CUT, " " * 6)).otherwise(text)
    return _spaced(plain, lambda s: F.regexp_replace(clean, f"{s}{{2,}}([A-Za-z ]{{1,{HEADER_CHARS}}}):{s}{{2,}}", f"{SECTION}$1{TITLE_END}"))


def _listed(x: Column, plain: Column) -> Column:
    """Of a text with marked headers: a mark before each list item and after each paragraph."""

    def step(s: str) -> Column:
        opener = f"(^{s}*|{s}{{2,}}|;{s}+or{s}+|{TITLE_END})"
        numbered = F.regexp_replace(x, f"{opener}[0-9]+\\.{s}", f"$1{CUT}{NUMBERED}")
        # "; or" before an item belongs to neither of the two
        numbered = F.when(F.contains(numbered, F.lit(";")), F.regexp_replace(numbered, f";{s}+or{s}+{CUT}", CUT)).otherwise(numbered)
        return F.when(x.rlike(f"(^{s}*|{s}{{2,}}|{TITLE_END})1\\.{s}"), numbered).otherwise(x)

    return F.when(F.contains(x, F.lit("1.")), _spaced(plain, step)).otherwise(x)


def _cut(x: Column, plain: Column) -> Column:
    for bullet in BULLETS:
        x = F.replace(x, F.lit(bullet), F.lit(CUT + BULLET))
    return _spaced(plain, lambda s: F.regexp_replace(x, f"{s}{{3,}}", CUT + PARAGRAPH))


def _trimmed(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACES))


def _sections(marked: Column) -> Column:
    """Array of (title or null, body) of a marked text, in its order."""
    parts = F.split(marked, SECTION)
    return F.transform(
        parts,
        lambda s, i: F.struct(
            F.when(i > 0, _trimmed(F.substring_index(s, TITLE_END, 1))).alias("title"),
            F.when(i > 0, F.substring(s, F.length(F.substring_index(s, TITLE_END, 1)) + 2, F.length(s))).otherwise(s).alias("body"),
        ),
    )


def _pieces(body: Column) -> Column:
    """Array of (kind, text) of a section's body, without empty pieces."""
    kind = lambda p: F.when(p.startswith(NUMBERED), "numbered").when(p.startswith(BULLET), "bullet").otherwise("paragraph")
    text = lambda p: F.btrim(p, F.lit(NUMBERED + BULLET + PARAGRAPH + SPACES))  # noqa: E731  the mark is its first character
    parts = F.transform(F.split(body, CUT), lambda p: F.struct(kind(p).alias("kind"), text(p).alias("text")))
    return F.filter(parts, lambda p: p["text"] != "")


def _html(title: Column, pieces: Column) -> Column:
    """A section's HTML from its pieces."""
    tag = lambda p: F.when(p["kind"] == "numbered", "ol").when(p["kind"] == "bullet", "ul")
    at = lambda i: F.when((i >= 1) & (i <= F.size(pieces)), F.element_at(pieces, F.greatest(i, F.lit(1))))

    def element(p: Column, i: Column) -> Column:
        listed = p["kind"] != "paragraph"
        opens = listed & ~F.coalesce(at(i)["kind"] == p["kind"], F.lit(False))
        closes = listed & ~F.coalesce(F.get(pieces, i + 1)["kind"] == p["kind"], F.lit(False))
        none = F.lit("")
        return F.concat(
            F.when(opens, F.concat(F.lit("<"), tag(p), F.lit(">"))).otherwise(none),
            F.when(listed, "<li>").otherwise("<p>"),
            escape_html(p["text"]),
            F.when(listed, "</li>").otherwise("</p>"),
            F.when(closes, F.concat(F.lit("</"), tag(p), F.lit(">"))).otherwise(none),
        )

    head = F.when(F.length(title) > 0, F.concat(F.lit("<h4>"), escape_html(title), F.lit("</h4>"))).otherwise(F.lit(""))
    return F.concat(head, F.array_join(F.transform(pieces, element), ""))


def _marked(df: DataFrame, keep: list, source: str) -> DataFrame:
    """``keep`` and the sections as ``__s``, each step as a projection of its own: a text that a step
    looks at twice is not made twice."""
    plain = F.col("__plain")  # marks are no white space: it holds for all steps
    out = df.select(*keep, F.col(source).alias("__x"), _plain(F.col(source)).alias("__plain"))
    for step in (_headed, _listed, _cut):
        out = out.select(*keep, step(F.col("__x"), plain).alias("__x"), plain)
    return out.select(*keep, _sections(F.col("__x")).alias("__s"))


def structure_text(c: ColumnOrName) -> Column:
    """P18 (with P19): text -> HTML fragment, as one Column expression (for a page of rows; for whole
    tables use :func:`with_structured_text`)."""
    plain = _plain(col(c))
    sections = _sections(_cut(_listed(_headed(col(c), plain), plain), plain))
    staged = F.transform(sections, lambda s: F.struct(s["title"].alias("title"), _pieces(s["body"]).alias("pieces")))
    return F.array_join(F.transform(staged, lambda s: _html(s["title"], s["pieces"])), "")


def with_structured_text(df: DataFrame, source: str, out: str) -> DataFrame:
    """P18 over a frame."""
    keep = [c for c in df.columns if c != out]
    staged = _marked(df, keep, source)
    staged = staged.select(*keep, F.transform("__s", lambda s: F.struct(s["title"].alias("title"), _pieces(s["body"]).alias("pieces"))).alias("__s"))
    return staged.select(*keep, F.array_join(F.transform("__s", lambda s: _html(s["title"], s["pieces"])), "").alias(out))


def text_items(df: DataFrame, id_col: str, source: str) -> DataFrame:
    """P18, long form: ``id_col, section_no, section, item_no, kind, text``, one row per piece
    (numbers from 0; the part before the first header has a null section)."""
    # outer explodes: for a plain one Spark infers a filter on the array's size, and makes the array twice
    sections = _marked(df, [id_col], source).select(id_col, F.posexplode_outer("__s").alias("section_no", "s")).where("s IS NOT NULL")
    items = sections.select(id_col, "section_no", F.col("s.title").alias("section"), F.posexplode_outer(_pieces(F.col("s.body"))).alias("item_no", "p"))
    items = items.where("p IS NOT NULL")
    return items.select(id_col, "section_no", "section", "item_no", F.col("p.kind").alias("kind"), F.col("p.text").alias("text"))
