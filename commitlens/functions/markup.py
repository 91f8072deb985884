"""Plain text out of marked-up text, block by block.

A text is cut into blocks by one regular expression, which sees where a fence, a table, a list item or a directive ends;
then each block is read by its kind, and inline markup is taken out everywhere but in code. All of it
is built-in functions, and the work grows with the text's length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commitlens.functions.binding import change_if, let

# Stand for a code span, and for escaped signs, while the inline rules run. Private characters, taken out of texts first.
_CODE, _ESCAPED = "\ue000", {s: chr(0xE010 + i) for i, s in enumerate("*_[]`#<>\\!|~(){}")}
_PRIVATE = "[\ue000-\ue0ff]"

# Repeated groups are possessive, which Java runs as a loop; otherwise long blocks would need a deep stack.
_FENCE = r"[ \t]*(?<fence>`{3,}|~{3,})(?:(?<=`)[^`\n]*|(?<=~)[^\n]*)\n(?s:.*?)(?:(?<=\n)[ \t]*\k<fence>[`~]*[ \t]*\n|\z)"
_COMMENT = r"[ ]{0,3}<!--(?s:.*?)-->[ \t]*\n"
_TARGET = r"[ ]{0,3}\[(?!\^)[^\[\]\n]+\]:[ \t]*\S[^\n]*\n"
_RULE = r"[ \t]*:?-+:?[ \t]*"
_TABLE = rf"[^\n]*\|[^\n]*\n(?=[^\n]*\|)[ ]{{0,3}}\|?{_RULE}(?:\|{_RULE})*+\|?[ \t]*\n(?:[^\n]*\|[^\n]*\n)*+"
_ITEM = r"[ ]{0,3}(?:[-*+]|\d{1,9}[.)])[ \t]+\S[^\n]*\n(?:[ \t]+\S[^\n]*\n|[ \t]*\n(?=[ \t]*\n|[ ]{2,}\S|\t\S))*+"
_TITLE = r"(?![ ]{0,3}(?:\#{1,6}[ \t]|>|[-*+][ \t]|\d{1,9}[.)][ \t]|={2,}|-{2,}))[ ]{0,3}\S[^\n]*\n[ ]{0,3}(?:=+|-{2,})[ \t]*\n"
_INDENTED = r"(?<=\A|\n[ \t]{0,3}\n)(?:(?:[ ]{4}|\t)[^\n]*\S[^\n]*\n|[ \t]*\n(?=[ ]{4}[^\n]*\S|\t[^\n]*\S))++"
_LINE = r"[^\n]*\n"
_INNER = f"{_FENCE}|{_LINE}"
_MARKDOWN = "|".join([_FENCE, _COMMENT, _TARGET, _TABLE, _ITEM, _TITLE, _INDENTED, _LINE])

_CODE_SPAN = r"(?<!`)(?<ticks>`++)(?!`)[ ]?((?s:.+?))[ ]?(?<!`)\k<ticks>(?!`)"


def _blocks(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def _starts(block: Column, pattern: str) -> Column:
    return block.rlike(r"\A(?:" + pattern + ")")


def _replaced(c: Column, *rules: tuple[str, str]) -> Column:
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def _outside_code(c: Column, code: str, content: int, inline) -> Column:
    """``inline`` over everything but the code spans, whose contents come back as they are."""

    def joined(t: Column) -> Column:
        spans = F.regexp_extract_all(t, F.lit(code), F.lit(content))
        parts = F.split(inline(F.regexp_replace(t, code, _CODE)), _CODE)
        return F.array_join(F.zip_with(parts, spans, lambda p, s: F.concat(p, F.coalesce(s, F.lit("")))), "")

    return let(c, joined)


def _hidden(c: Column) -> Column:
    """Escaped signs as private characters, so that no rule takes them for markup."""

    def every(t: Column) -> Column:
        for sign, stand_in in _ESCAPED.items():
            t = F.replace(t, F.lit("\\" + sign), F.lit(stand_in))
        return t

    return change_if(c, lambda t: t.contains("\\"), every)


def _shown(c: Column) -> Column:
    return F.translate(c, "".join(_ESCAPED.values()), "".join(_ESCAPED))


def _named_links(c: Column, labels: Column) -> Column:
    """``[text][label]``, ``[text][]`` and ``[label]`` as their text, where the label is one of the text's own."""

    def pieces(t: Column) -> Column:
        return F.regexp_extract_all(t, F.lit(r"!?\[[^\[\]\n]*\](?:\[[^\[\]\n]*\])?|[^\[!]++|[\[!]"), F.lit(0))

    def read(p: Column) -> Column:
        text = F.regexp_extract(p, r"\A!?\[([^\[\]\n]*)\]", 1)
        label = F.regexp_extract(p, r"\]\[([^\[\]\n]+)\]\z", 1)
        known = F.array_contains(labels, F.lower(F.when(label == "", text).otherwise(label)))
        return F.when(p.rlike(r"\A!?\[[^\[\]\n]*\]") & known, text).otherwise(p)

    return change_if(c, lambda t: (F.size(labels) > 0) & t.contains("["), lambda t: F.array_join(F.transform(pieces(t), read), ""))


def _markdown_inline(c: Column, labels: Column) -> Column:
    link = (r"!?\[([^\[\]]*)\]\([^()\s\ue000]*(?:\([^()\s\ue000]*\)[^()\s\ue000]*)?(?:[ \t]+(?:\"[^\"]*\"|'[^']*'))?[ \t]*\)", "$1")

    bare = (r"<((?:https?|ftp|mailto):[^<>\s]+)>", "$1"), (r"</?[A-Za-z][^<>\ue000]*>", "")
    emphasis = (
        (r"\*\*(?=\S)(.+?)(?<=\S)\*\*", "$1"),
        (r"(?<![\w*])\*(?=[^\s*])([^*\n]+?)(?<=\S)\*(?![\w*])", "$1"),
        (r"(?<!\w)__(?=\S)(.+?)(?<=\S)__(?!\w)", "$1"),
        (r"(?<!\w)_(?=[^\s_])([^_\n]+?)(?<=\S)_(?!\w)", "$1"),
        (r"~~(?=\S)(.+?)(?<=\S)~~", "$1"),
    )

    def rules(t: Column) -> Column:
        # Twice: a link may have a picture for its text.
        t = change_if(t, lambda x: x.contains("]("), lambda x: _replaced(x, link, link))
        t = change_if(_named_links(t, labels), lambda x: x.contains("<"), lambda x: _replaced(x, *bare))
        return change_if(t, lambda x: x.rlike("[*_~]"), lambda x: _replaced(x, *emphasis))

    return _shown(_outside_code(_hidden(c), _CODE_SPAN, 2, rules))


def _fence_body(block: Column) -> Column:
    """What stands between the lines of a fence, as it is."""
    return _replaced(block, (r"\A[^\n]*\n", ""), (r"(?<=\n|\A)[ \t]*(?:`{3,}|~{3,})[`~ \t]*\n\z", ""))


def _table_rows(block: Column, inline) -> Column:
    """Cells by two spaces, a row a line; the line of dashes is none."""

    def row(line: Column) -> Column:
        cells = F.split(_replaced(F.trim(line), (r"\A\||(?<!\\)\|\z", "")), r"(?<!\\)\|")
        return F.concat(F.array_join(F.transform(cells, lambda x: F.trim(inline(x))), "  "), F.lit("\n"))

    lines = _blocks(block, _LINE)
    kept = F.filter(lines, lambda x, i: i != 1)
    return F.array_join(F.transform(kept, lambda x: row(F.regexp_replace(x, r"\n\z", ""))), "")


def markdown_to_plain(c: Column) -> Column:
    """Headings, lists, quotes, tables, links and emphasis as their text; code in fences, indented or in ticks as it is.

    A table is its cells two spaces apart, a row a line. Lines that define links, comments and
    horizontal rules go. List items and quotes keep their text line by line; a list's marker is ``-`` or its number.
    """
    text = F.concat(_replaced(c, (_PRIVATE, "\ufffd"), (r"\r\n?", "\n")), F.lit("\n"))

    def labels(t: Column) -> Column:
        return F.transform(F.regexp_extract_all(t, F.lit(r"(?m)^[ ]{0,3}\[((?!\^)[^\[\]\n]+)\]:[ \t]*\S"), F.lit(1)), F.lower)

    # Bound outside of the blocks: the labels are looked for once a text.
    plain = let(text, lambda t: let(labels(t), lambda found: _markdown_blocks(t, found)))
    return F.regexp_replace(plain, r"\n\z", "")


def _markdown_blocks(text: Column, labels: Column) -> Column:
    def inline(t: Column) -> Column:
        return _markdown_inline(t, labels)

    def line(t: Column) -> Column:
        """The line without its mark, then without inline markup."""
        heading = _replaced(t, (r"\A[ ]{0,3}#{1,6}(?:[ \t]+|(?=\n))", ""), (r"(?:[ \t]+#+)?[ \t]*\n\z", "\n"))
        return inline(
            F.when(t.rlike(r"\A[ ]{0,3}(?:(?:\*[ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})\n\z"), F.lit(""))
            .when(_starts(t, r"[ ]{0,3}#{1,6}[ \t\n]"), heading)
            .when(_starts(t, r"[ ]{0,3}>"), F.regexp_replace(t, r"\A(?:[ ]{0,3}>[ \t]?)+", ""))
            .when(_starts(t, r"[ \t]*[*+][ \t]"), F.regexp_replace(t, r"\A([ \t]*)[*+](?=[ \t])", "$1-"))
            .otherwise(t)
        )

    def inner(block: Column) -> Column:
        parts = _blocks(block, _INNER)
        return F.array_join(F.transform(parts, lambda p: F.when(_starts(p, _FENCE), _fence_body(p)).otherwise(line(p))), "")

    def read(block: Column) -> Column:
        # Most lines hold nothing that could be markup.
        return (
            F.when(~block.rlike(r"[^\p{L}\p{N} .,;:?'\n]|\n.|\A[ \t]"), block)
            .when(_starts(block, _FENCE), _fence_body(block))
            .when(_starts(block, _COMMENT) | _starts(block, _TARGET + r"\z"), F.lit(""))
            .when(_starts(block, _TABLE), _table_rows(block, inline))
            .when(_starts(block, _ITEM), inner(block))
            .when(block.rlike(r"\A(?:[ ]{4}|\t)[^\n]*\n"), F.regexp_replace(block, r"(?m)^(?:[ ]{4}|\t)", ""))
            .otherwise(line(F.when(_starts(block, _TITLE), _replaced(block, (r"\A[ ]+", ""), (r"[ \t]*\n[^\n]*\n\z", "\n"))).otherwise(block)))
        )

    return F.array_join(F.transform(_blocks(text, _MARKDOWN), read), "")


_BODY = r"(?:[ \t]+\S[^\n]*\n|[ \t]*\n(?=(?:[ \t]*\n)*+[ \t]+\S))*+"
_CODE_DIRECTIVE = rf"\.\.[ \t]+(?:code|code-block|sourcecode|parsed-literal|math)::[^\n]*\n{_BODY}"
_DIRECTIVE = rf"\.\.[ \t]+(?:\|[^|\n]+\|[ \t]+)?[\w:-]+::[^\n]*\n(?:[ \t]+:[\w -]+:[^\n]*\n)*+"
_RST_TARGET = r"\.\.[ \t]+_[^\n]*:[^\n]*\n|__[ \t]+\S[^\n]*\n"
_RST_COMMENT = rf"\.\.(?:[ \t]+(?![\w:-]+::|\||_|\[)[^\n]*)?\n{_BODY}"
_LITERAL = rf"(?!\.\.[ \t])[^\n]*::[ \t]*\n(?:[ \t]*\n)++[ \t]+\S[^\n]*\n{_BODY}"
_GRID = r"[ \t]*\+(?:[-=]+\+)+[ \t]*\n"
_RST = "|".join([_CODE_DIRECTIVE, _DIRECTIVE, _RST_TARGET, _RST_COMMENT, _LITERAL, _GRID, _LINE])
_RST_CODE = r"``((?s:.+?))``"


def rst_to_plain(c: Column) -> Column:
    """Titles, directives, tables, roles and links as their text; literal blocks, code directives and literals as they are.

    Of a directive that is no code the head and its options go and the body stays. Comments and link targets go. A table is its
    rows, cells of a grid two spaces apart.
    """
    text = F.concat(_replaced(c, (_PRIVATE, "\ufffd"), (r"\r\n?", "\n")), F.lit("\n"))

    def inline(t: Column) -> Column:
        quoted = (
            (r":[\w:.+-]+:`([^`<\n]+?)[ \t]*<[^>\n]*>`", "$1"), (r":[\w:.+-]+:`([^`]+)`", "$1"),
            (r"`([^`<\n]+?)[ \t]*<[^>\n]*>`__?", "$1"), (r"`([^`\n]+)`(?:__?(?!\w))?", "$1"),
        )
        strong = (r"\*\*(?=\S)(.+?)(?<=\S)\*\*", "$1"), (r"(?<![\w*])\*(?=[^\s*])([^*\n]+?)(?<=\S)\*(?![\w*])", "$1")

        def rules(x: Column) -> Column:
            x = change_if(x, lambda v: v.contains("`"), lambda v: _replaced(v, *quoted))
            return change_if(x, lambda v: v.contains("*"), lambda v: _replaced(v, *strong))

        return _shown(_outside_code(_hidden(t), _RST_CODE, 1, rules))

    def body(block: Column) -> Column:
        """A code block without its head, options and common four or three spaces."""
        return F.regexp_replace(F.regexp_replace(block, r"\A(?:[ \t]+:[\w-]+:[^\n]*\n)*+(?:[ \t]*\n)*+", ""), r"(?m)^(?:[ ]{1,4}|\t)", "")

    def literal(block: Column) -> Column:
        head = F.regexp_extract(block, r"\A([^\n]*)::[ \t]*\n", 1)
        rest = F.regexp_replace(block, r"\A[^\n]*\n(?:[ \t]*\n)*+", "")
        said = F.when(F.trim(head) != "", F.concat(inline(F.rtrim(head)), F.lit(":\n\n"))).otherwise(F.lit(""))
        return F.concat(said, F.regexp_replace(rest, r"(?m)^(?:[ ]{1,4}|\t)", ""))

    def cells(row: Column) -> Column:
        inside = _replaced(F.trim(F.regexp_replace(row, r"\n\z", "")), (r"\A\||\|\z", ""))
        return F.concat(F.array_join(F.transform(F.split(inside, r"\|"), lambda x: F.trim(inline(x))), "  "), F.lit("\n"))

    def read(block: Column) -> Column:
        return (
            F.when(~block.rlike(r"[^\p{L}\p{N} ,;?\n]|\n.|\A[ \t]"), block)
            .when(_starts(block, _CODE_DIRECTIVE), body(F.regexp_replace(block, r"\A[^\n]*\n", "")))
            .when(_starts(block, _DIRECTIVE) | _starts(block, _RST_TARGET) | _starts(block, _RST_COMMENT) | _starts(block, _GRID), F.lit(""))
            .when(_starts(block, _LITERAL), literal(block))
            .when(block.rlike(r"\A(?:[=\-`:.'^~*+#\"]{2,}[ \t]*)++\n\z"), F.lit(""))
            .when(block.rlike(r"\A[ \t]*\|.*\|[ \t]*\n\z"), cells(block))
            .otherwise(inline(F.regexp_replace(block, r"\A([ \t]*)[*+](?=[ \t])", "$1-")))
        )

    return F.regexp_replace(F.array_join(F.transform(_blocks(text, _RST), read), ""), r"\n\z", "")
