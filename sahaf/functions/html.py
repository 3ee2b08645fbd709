"""HTML to Markdown with built-in functions.

Covers headings, paragraphs, links, images, bold, italic, code, rules, nested
ordered and unordered lists, and pipe tables. A page need not be well formed: tags
without a partner are dropped and their text is kept. Text inside ``pre`` keeps its line
breaks, blanks and marks; an ordered list counts its items, from ``start`` where it is given.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values. Each rule is (pattern, replacement), applied in this order.
# \x02 stands for one column of list indentation until blanks have been squeezed.
DROP_RULES = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script\b[^>]*>.*?</script\s*>", ""),
    (r"(?is)<style\b[^>]*>.*?</style\s*>", ""),
    (r"(?is)<head\b[^>]*>.*?</head\s*>", ""),
    (r"(?is)<!doctype[^>]*>", ""),
]
INLINE_RULES = [
    (r"[ \t\r\n\f]{2,}|[\t\r\n\f]", " "),
    (r"([*_])", r"\\$1"),
    (r"(?i)</?(?:font|span|u|small|big|abbr|time|label)\b[^>]*>", ""),
    (r"(?i)<h1\b[^>]*> *", "\n\n# "),
    (r"(?i)<h2\b[^>]*> *", "\n\n## "),
    (r"(?i)<h3\b[^>]*> *", "\n\n### "),
    (r"(?i)<h4\b[^>]*> *", "\n\n#### "),
    (r"(?i)<h5\b[^>]*> *", "\n\n##### "),
    (r"(?i)<h6\b[^>]*> *", "\n\n###### "),
    (r"(?i)</h[1-6]\s*>", "\n\n"),
    (r'(?i)<img\b[^>]*?\balt="([^"]*)"[^>]*?\bsrc="([^"]*)"[^>]*>', "![$1]($2)"),
    (r'(?i)<img\b[^>]*?\bsrc="([^"]*)"[^>]*?\balt="([^"]*)"[^>]*>', "![$2]($1)"),
    (r'(?i)<img\b[^>]*?\bsrc="([^"]*)"[^>]*>', "![]($1)"),
    (r"(?i)<pre\b[^>]*> *(?:<code\b[^>]*>)?", "\n\n```\n"),
    (r"(?i)(?:</code\s*>)? *</pre\s*>", "\n```\n\n"),
    (r"(?i)<code\b[^>]*>([^<]*)</code\s*>", "`$1`"),
    (r"(?i)<(?:i|em)\b[^>]*> *([^<]*[^< ]) *</(?:i|em)\s*>", "*$1*"),
    (r"(?i)<(?:b|strong)\b[^>]*> *([^<]*[^< ]) *</(?:b|strong)\s*>", "**$1**"),
    (r'(?i)<a\b[^>]*?\bhref="([^"]*)"[^>]*> *([^<]*[^< ]) *</a\s*>', "[$2]($1)"),
    (r"(?i)<a\b[^>]*?\bhref='([^']*)'[^>]*> *([^<]*[^< ]) *</a\s*>", "[$2]($1)"),
    (r"(?i)<br\b[^>]*>", "\n"),
    (r"(?i)<hr\b[^>]*>", "\n\n---\n\n"),
]
LEADING_RULES = [*DROP_RULES, *INLINE_RULES]
ITEM = r"(?i)<li\b[^>]*> *"
ROW_RULES = [
    (r"(?i)<tr\b[^>]*> *", "\n|"),
    (r"(?i) *<t[dh]\b[^>]*> *", " "),
    (r"(?i) *</t[dh]\s*>", " |"),
]
TRAILING_RULES = [
    (r"(?i)</?(?:p|div|section|article|main|nav|header|footer|aside|table|ul|ol|dl|blockquote|body|html)\b[^>]*>", "\n\n"),
    (r"(?i)<d[td]\b[^>]*>", "\n"),
    (r"</?[a-zA-Z][^<>]*>", ""),
]
#: Named entities and their characters, from Python's table; a no-break space becomes a blank, ``&amp;`` is left for last.
ENTITIES = [(f"&{name};", " " if name == "nbsp" else chr(code)) for name, code in name2codepoint.items() if name != "amp"]
ENTITIES.append(("&apos;", "'"))
BLANK_RULES = [
    (r"[ \t\x{A0}]{2,}|[\t\x{A0}]", " "),
    (r" \n ?|\n ", "\n"),
    (r"\n{3,}", "\n\n"),
]
BULLETS = "*+-"
#: What stands for line breaks, blanks, tabs and marks of ``pre`` until all rules were applied.
KEPT, STANDS = "\n \t*_", "\x03\x04\x05\x06\x07"
PRE = r"(?is)^(<pre\b[^>]*>)(?:\r?\n)?(.*?)(?:\r?\n)?(</pre\s*>.*|$)"


def apply_rules(text: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def _set_aside(piece: Column, i: Column) -> Column:
    """A piece that begins with ``pre``, with signs for the blanks and marks inside it."""
    body = F.translate(F.replace(F.regexp_extract(piece, PRE, 2), F.lit("\r")), KEPT, STANDS)
    whole = F.concat(F.regexp_extract(piece, PRE, 1), body, F.regexp_extract(piece, PRE, 3))
    return F.when((i == 0) | ~piece.rlike(PRE), piece).otherwise(whole)


def _stacks(pieces: Column) -> Column:
    """For each piece the open lists, as a string of ``u`` and ``o``, and how many items the last one had before it.

    The first entry is the state before all pieces.
    """

    def step(state, piece):
        before = F.element_at(state, -1)
        head = F.lower(F.substring(piece, 1, 3))
        less = F.greatest(F.length(before["lists"]) - 1, F.lit(0))
        lists = (
            F.when(head == "<ul", F.concat(before["lists"], F.lit("u")))
            .when(head == "<ol", F.concat(before["lists"], F.lit("o")))
            .when(head.isin("</u", "</o"), before["lists"].substr(F.lit(1), less))
            .otherwise(before["lists"])
        )
        given = F.regexp_extract(piece, r"""(?i)^<ol\b[^>]*?\bstart=["']?(\d{1,9})""", 1)
        begin = F.when(given == "", F.lit(0)).otherwise(given.cast("int") - 1)
        counts = (
            F.when(head.isin("<ul", "<ol"), F.concat(before["counts"], F.array(begin)))
            .when(head.isin("</u", "</o"), F.slice(before["counts"], F.lit(1), less))
            .otherwise(before["counts"])
        )
        items = F.size(F.split(piece, ITEM, -1)) - 1

        def after(c):
            had = F.coalesce(F.get(c, F.size(c) - 1), F.lit(0))
            held = F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0)))
            grown = F.when(F.size(c) > 0, F.concat(held, F.array(had + items))).otherwise(c)
            return F.struct(lists.alias("lists"), had.alias("had"), grown.alias("counts"))

        return F.concat(state, F.transform(F.array(counts), after))

    none = F.struct(F.lit("").alias("lists"), F.lit(0).alias("had"), F.array().cast("array<int>").alias("counts"))
    return F.aggregate(pieces, F.array(none), step)


def _list_piece(piece: Column, state: Column) -> Column:
    """Items of one piece with the mark and indentation of their depth."""
    stack = state["lists"]
    depth = F.length(stack)
    bullet = F.substring(F.lit(BULLETS), F.pmod(F.greatest(depth - 1, F.lit(0)), F.lit(3)) + 1, F.lit(1))
    indent = F.concat(F.lit("\n"), F.repeat(F.lit("\x02\x02"), F.greatest(depth - 1, F.lit(0))))
    nested = (depth > 1) | ((depth == 1) & piece.startswith("</"))
    text = F.when(nested, F.regexp_replace(piece, r"(?i)^</?[ou]l\b[^>]*> *", "")).otherwise(piece)
    number = lambda i: F.concat(indent, (state["had"] + i).cast("string"), F.lit(". "))
    numbered = F.transform(F.split(text, ITEM, -1), lambda x, i: F.when(i == 0, x).otherwise(F.concat(number(i), x)))
    marked = F.regexp_replace(text, F.lit(ITEM), F.concat(indent, bullet, F.lit(" ")))
    return F.when(stack.endswith("o"), F.array_join(numbered, "")).otherwise(marked)


def _table_row(row: Column) -> Column:
    """One pipe row; the first row of a table is followed by the separator row."""
    cells = F.size(F.split(row, r"(?i)<t[dh]\b")) - 1
    rule = F.concat(F.lit("\n|"), F.repeat(F.lit(" --- |"), cells))
    first = row.rlike(r"(?i)<table\b") & (cells > 0)
    return F.concat(apply_rules(row, ROW_RULES), F.when(first, rule).otherwise(""))


def _numeric_entity(piece: Column, i: Column) -> Column:
    """The piece after ``&#`` with its number as a character: ``231;`` or ``xE7;``."""
    digits = F.regexp_extract(piece, r"^(\d{1,7});", 1)
    hexed = F.regexp_extract(piece, r"^[xX]([0-9a-fA-F]{1,6});", 1)
    code = F.when(digits != "", digits.cast("int")).when(hexed != "", F.conv(hexed, 16, 10).cast("int"))
    valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    safe = F.when(valid, code).otherwise(F.lit(32))
    char = F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")
    rest = F.regexp_replace(piece, r"^[0-9a-fA-FxX]+;", "")
    return (
        F.when(i == 0, piece).when(valid, F.concat(char, rest)).otherwise(F.concat(F.lit("&#"), piece))
    )


def _named_entity(piece: Column, i: Column) -> Column:
    """The piece after ``&`` with its name, up to a semicolon, as a character, by one lookup."""
    name = F.regexp_extract(piece, r"^([a-zA-Z][a-zA-Z0-9]*;)", 1)
    table = F.create_map(*[F.lit(x) for entity, char in ENTITIES for x in (entity[1:], char)])
    char = F.when(name != "", F.element_at(table, name))
    rest = F.substr(piece, F.length(name) + 1)
    return F.when(i == 0, piece).when(char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), piece))


def html_to_markdown(df: DataFrame, html_col: str = "html", out_col: str = "markdown") -> DataFrame:
    """Add the Markdown of an HTML column.

    The steps are separate columns so that each is computed once per row. The blank before
    the page leaves no piece that begins with ``pre`` as the first; it is trimmed at the end.
    """
    whole = F.when(F.size("_pre") == 1, F.get("_pre", F.lit(0))).otherwise(F.array_join(F.transform("_pre", _set_aside), ""))
    text = apply_rules(whole, INLINE_RULES)
    lists = F.array_join(
        F.transform("_pieces", lambda piece, i: _list_piece(piece, F.get("_stacks", i + 1))), ""
    )
    tables = F.when(F.size("_rows") == 1, F.get("_rows", F.lit(0))).otherwise(
        F.array_join(F.transform("_rows", _table_row), "")
    )
    inline = apply_rules(tables, TRAILING_RULES)
    named = F.when(F.size("_names") == 1, F.get("_names", F.lit(0))).otherwise(
        F.array_join(F.transform("_names", _named_entity), "")
    )
    numbers = F.when(F.size("_numbers") == 1, F.get("_numbers", F.lit(0))).otherwise(
        F.array_join(F.transform("_numbers", _numeric_entity), "")
    )
    marked = F.regexp_replace(text, r"(?i)(</?[ou]l\b)", "\x01$1")
    final = F.replace(
        F.btrim(apply_rules(F.replace(numbers, F.lit("&amp;"), F.lit("&")), BLANK_RULES), F.lit(" \n")),
        F.lit("\x02"),
        F.lit(" "),
    )
    return (
        df.withColumn("_pre", F.split(F.concat(F.lit(" "), apply_rules(F.col(html_col), DROP_RULES)), r"(?i)(?=<pre\b)", -1))
        .withColumn("_pieces", F.split(marked, "\x01", -1))
        .withColumn("_stacks", _stacks(F.col("_pieces")))
        .withColumn("_rows", F.split(lists, r"(?i)</tr\s*> *", -1))
        .withColumn("_names", F.split(inline, "&", -1))
        .withColumn("_numbers", F.split(named, "&#", -1))
        .withColumn(out_col, F.when(F.size("_pre") == 1, final).otherwise(F.translate(final, STANDS, KEPT)))
        .drop("_pre", "_pieces", "_stacks", "_rows", "_names", "_numbers")
    )
