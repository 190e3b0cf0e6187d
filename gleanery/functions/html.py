"""HTML as a browser reads it, in built-in expressions over one record.

A page is cut into tokens: comments, elements of raw text, tags with quoted attribute values, and text. The tags of tables are
folded by a stack machine that holds the open tables, with the section, row and cell open in each, and knows the ends that
HTML implies. What it closes comes out as ranges of tokens. Spark copies the state of a fold at each step, so what has come out
so far is one flat string, and the fold runs in chunks: the time grows with the page, not with its square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.columns import col, sql_text, strip

# A tag from its name on; values in quotes may hold any character.
_TAG = r"""[a-zA-Z][^\s/>]*+(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+>"""
_RAW = "script|style|xmp|iframe|noembed|noframes"
_RAW_START = rf"""<(?:{_RAW})(?=[\s/>])(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+>"""
_COMMENT = r"<!--.*?(?:--!?>|\z)"
_TOKEN = rf"(?is){_COMMENT}|{_RAW_START}.*?(?:</(?:{_RAW})(?=[\s/>])[^>]*+>|\z)|</?{_TAG}|<[!?/a-z][^>]*+(?:>|\z)|[^<]++|<"
_NOT_TEXT = rf"(?is){_COMMENT}|</?{_TAG}|<[!?/a-z][^>]*+(?:>|\z)"
_VALUE = r"""("[^"]*+"|'[^']*+'|[^\s>]*+)"""

# What character references stand for: the common names, and what browsers read for the numbers 128 to 159. Fixed values.
_NAMES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "trade": "™",
    "middot": "·", "bull": "•", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“",
    "rdquo": "”", "laquo": "«", "raquo": "»", "times": "×", "deg": "°", "euro": "€", "pound": "£", "yen": "¥", "cent": "¢",
    "sect": "§", "para": "¶", "larr": "←", "rarr": "→", "uarr": "↑", "darr": "↓", "star": "☆", "starf": "★", "check": "✓",
    "hearts": "♥", "eacute": "é", "egrave": "è", "agrave": "à", "aacute": "á", "iacute": "í", "oacute": "ó", "uacute": "ú",
    "ntilde": "ñ", "ccedil": "ç", "auml": "ä", "ouml": "ö", "uuml": "ü", "Auml": "Ä", "Ouml": "Ö", "Uuml": "Ü", "szlig": "ß",
}
_NAMES_SQL = "map(" + ", ".join(sql_text(x) for pair in _NAMES.items() for x in pair) + ")"
_C1 = "".join(map(chr, range(0x80, 0xA1)))
_C1_READ = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ "

CHUNK = 256

# Codes of table tags: ends are negative.
_TABLE, _BODY, _HEAD, _ROW, _DATA, _HEADING, _CAPTION = range(1, 8)
_CODES = {"table": _TABLE, "tbody": _BODY, "thead": _HEAD, "tfoot": _HEAD, "tr": _ROW, "td": _DATA, "th": _HEADING, "caption": _CAPTION}

_CODES_SQL = "map(" + ", ".join(f"'<{tag}', {code}, '</{tag}', {-code}" for tag, code in _CODES.items()) + ")"

_STACK = "array<struct<outer:boolean,section:int,row:int,row_from:int,cell:int,cell_no:int,cell_at:int>>"
_NAMES_OF_STACK = ("outer", "section", "row", "row_from", "cell", "cell_no", "cell_at")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def tokens(html: str | Column) -> Column:
    return F.regexp_extract_all(col(html), F.lit(_TOKEN), F.lit(0))


def unescaped(text: Column) -> Column:
    """Character references read: numbers, and the common names."""

    def character(code: Column) -> Column:
        known = F.when((code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF), code).otherwise(0xFFFD)
        read = F.decode(F.unhex(F.lpad(F.hex(known), 8, "0")), "UTF-32")
        return F.translate(read, _C1, _C1_READ)

    def piece(part: Column, i: Column) -> Column:
        name = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*;|(?:amp|lt|gt|quot|nbsp|copy|reg)(?![a-zA-Z0-9=]));?", 1)
        rest = F.regexp_replace(part, r"^#?[a-zA-Z0-9]+;?", "")
        key = F.rtrim(name, F.lit(";"))
        hexed = F.conv(F.regexp_extract(part, r"^#[xX]([0-9a-fA-F]{1,6})", 1), 16, 10).try_cast("int")
        plain = F.regexp_extract(part, r"^#([0-9]{1,7})", 1).try_cast("int")
        named = F.try_element_at(F.expr(_NAMES_SQL), key)
        read = F.when(key.rlike("^#"), character(F.coalesce(hexed, plain))).otherwise(named)
        whole = F.concat(F.lit("&"), part)
        return F.when(i == 0, part).when(name == "", whole).otherwise(F.coalesce(F.concat(read, rest), whole))

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "&"), piece), "")).otherwise(text)


def text_of(html: str | Column) -> Column:
    """The text of a piece of HTML, trimmed."""
    return strip(unescaped(F.regexp_replace(col(html), _NOT_TEXT, "")))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a start tag, null without it; names inside other values are passed over."""
    other = rf"""(?:[\s/]*+(?!{name}[\s=/>])[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)*+"""
    found = rf"(?is)^<[a-z][^\s/>]*+{other}[\s/]*+{name}\s*+=\s*+{_VALUE}"
    value = F.regexp_extract(tag, found, 1)
    bare = F.regexp_replace(value, r"""^["']|["']$""", "")
    return F.when(tag.rlike(rf"(?is)^<[a-z][^\s/>]*+{other}[\s/]*+{name}[\s=/>]"), unescaped(F.when(value.rlike("^[\"']"), bare).otherwise(value)))


def start_tags(html: str | Column, name: str) -> Column:
    """The start tags of one name, in order."""
    return F.filter(tokens(html), lambda t: t.rlike(rf"(?i)^<{name}[\s/>]"))


def _code(token: Column) -> Column:
    """The code of a table tag, null for other tokens."""
    head = F.lower(F.regexp_extract(token, r"(?i)^</?(?:table|tbody|thead|tfoot|tr|td|th|caption)(?=[\s/>])", 0))
    return F.when(F.startswith(token, F.lit("<")), F.try_element_at(F.expr(_CODES_SQL), head))


def _open_table(outer: Column) -> Column:
    none = F.lit(-1)
    return F.struct(*[v.alias(n) for v, n in zip((outer, F.lit(0), none, none, F.lit(0), none, none), _NAMES_OF_STACK, strict=True)])


def _acc(stack: Column, n_rows: Column, n_cells: Column, done: Column, out: Column) -> Column:
    return F.struct(stack.alias("stack"), n_rows.alias("n_rows"), n_cells.alias("n_cells"), done.alias("done"), out.alias("out"))


def _row(table: Column, to: Column) -> Column:
    """A closed row: its number, whether it stands in a table body, and the numbers of its first cell and of the first behind it."""
    body = (table["outer"] | (table["section"] == 1)).cast("int")
    return F.concat_ws(",", F.lit("r"), table["row"], body, table["row_from"], to)


def _cell(table: Column, to: Column) -> Column:
    """A closed data cell: its number, the place of its start tag, and the place where it ends."""
    return F.concat_ws(",", F.lit("c"), table["cell_no"], table["cell_at"], to)


def _step(acc: Column, token: Column) -> Column:
    """One table tag: what it closes goes to ``out``, what it opens to the stack."""
    k, at = token["code"], token["at"]

    def inside(top: Column) -> Column:
        nested = (k == _TABLE) & (top["cell"] != 0)
        borders = k.isin(_BODY, _HEAD, _ROW, _CAPTION, -_TABLE, -_BODY, -_HEAD, -_ROW)
        ends_cell = borders | k.isin(_DATA, _HEADING) | ((k == -_DATA) & (top["cell"] == 1)) | (k.isin(-_HEADING, -_CAPTION) & (top["cell"] == 2))
        facts = F.struct(
            nested.alias("nested"),
            ((top["cell"] != 0) & ends_cell).alias("ends_cell"),
            ((top["row"] >= 0) & (borders | ((k == _TABLE) & ~nested))).alias("ends_row"),
            ((k == _ROW) | (k.isin(_DATA, _HEADING) & (top["row"] < 0))).alias("opens_row"),
        )
        return let(facts, lambda f: moved(top, f))

    def moved(top: Column, f: Column) -> Column:
        section = (
            F.when(k == _BODY, 1).when(k == _HEAD, 2).when(k.isin(-_BODY, -_HEAD), 0)
            .when(f["opens_row"] & (top["section"] == 0), 1).otherwise(top["section"])
        )
        new_cell = k.isin(_DATA, _HEADING, _CAPTION)
        values = (
            top["outer"],
            section,
            F.when(f["opens_row"], acc["n_rows"]).when(f["ends_row"], -1).otherwise(top["row"]),
            F.when(f["opens_row"], acc["n_cells"]).otherwise(top["row_from"]),
            F.when(k == _DATA, 1).when(new_cell, 2).when(f["ends_cell"], 0).otherwise(top["cell"]),
            F.when(k == _DATA, acc["n_cells"]).otherwise(top["cell_no"]),
            F.when(new_cell, at).otherwise(top["cell_at"]),
        )
        changed = F.struct(*[v.alias(n) for v, n in zip(values, _NAMES_OF_STACK, strict=True)])
        below = F.slice(acc["stack"], F.lit(1), F.size(acc["stack"]) - 1)
        stack = (
            F.when(f["nested"], F.array_append(acc["stack"], _open_table(top["outer"] | (top["section"] == 1))))
            .when(k == _TABLE, F.array_append(below, _open_table(top["outer"])))
            .when(k == -_TABLE, below)
            .otherwise(F.array_append(below, changed))
        )
        ended = (F.size(acc["stack"]) == 1) & ((k == -_TABLE) | ((k == _TABLE) & ~f["nested"]))
        closed = F.concat_ws(
            " ",
            acc["out"],
            F.when(f["ends_cell"] & (top["cell"] == 1), _cell(top, at)),
            F.when(f["ends_row"], _row(top, acc["n_cells"])),
        )
        n_rows, n_cells = acc["n_rows"] + f["opens_row"].cast("int"), acc["n_cells"] + (k == _DATA).cast("int")
        return _acc(F.when(ended, F.array().cast(_STACK)).otherwise(stack), n_rows, n_cells, ended, closed)

    first = _acc(F.array(_open_table(F.lit(False))), acc["n_rows"], acc["n_cells"], F.lit(False), acc["out"])
    waiting = F.when(k == _TABLE, first).otherwise(acc)
    return F.when(acc["done"], acc).when(F.size(acc["stack"]) == 0, waiting).otherwise(let(F.element_at(acc["stack"], -1), inside))


def first_table(page_tokens: Column) -> Column:
    """The rows of the page's first table that stand in a table body, nested ones included, in the order in which they begin:
    for each the HTML of its data cells, those of nested tables included."""
    places = F.transform(page_tokens, lambda t, i: F.struct(i.alias("at"), _code(t).alias("code")))
    tags = F.filter(places, lambda p: p["code"].isNotNull())
    begin = _acc(F.array().cast(_STACK), F.lit(0), F.lit(0), F.lit(False), F.lit(""))

    def folded(tags: Column) -> Column:
        def chunk(acc: Column, c: Column) -> Column:
            start = _acc(acc["stack"], acc["n_rows"], acc["n_cells"], acc["done"], F.lit(""))
            part = F.aggregate(F.slice(tags, c * CHUNK + 1, F.lit(CHUNK)), start, _step)
            return let(part, lambda p: _acc(p["stack"], p["n_rows"], p["n_cells"], p["done"], F.concat(acc["out"], p["out"])))

        return F.aggregate(F.sequence(F.lit(0), F.floor((F.size(tags) - 1) / CHUNK).cast("int")), begin, chunk)

    def events(end: Column) -> Column:
        """All that was closed, and what is open still and ends with the page."""
        rows = F.transform(F.filter(end["stack"], lambda t: t["row"] >= 0), lambda t: _row(t, end["n_cells"]))
        cells = F.transform(F.filter(end["stack"], lambda t: t["cell"] == 1), lambda t: _cell(t, F.size(page_tokens)))
        return F.transform(F.concat(F.split(end["out"], " "), rows, cells), lambda x: F.split(x, ","))

    def numbers(found: Column, kind: str, width: int) -> Column:
        """The events of one kind by their numbers, which count from 0 in the order in which they began."""
        some = F.filter(found, lambda x: F.get(x, F.lit(0)) == kind)
        return F.sort_array(F.transform(some, lambda x: F.array(*[F.get(x, F.lit(i)).cast("int") for i in range(1, width)])))

    def pieces(found: Column) -> Column:
        cut = F.transform(numbers(found, "c", 4), lambda c: F.array_join(F.slice(page_tokens, F.get(c, F.lit(1)) + 2, F.get(c, F.lit(2)) - F.get(c, F.lit(1)) - 1), ""))
        rows = F.filter(numbers(found, "r", 5), lambda r: F.get(r, F.lit(1)) == 1)
        return let(cut, lambda cells: F.transform(rows, lambda r: F.slice(cells, F.get(r, F.lit(2)) + 1, F.get(r, F.lit(3)) - F.get(r, F.lit(2)))))

    found = let(tags, lambda t: F.when(F.size(t) > 0, let(let(folded(t), events), pieces)))
    return F.coalesce(found, F.array().cast("array<array<string>>"))
