"""String columns: normalising, truncating, format guessing, templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commitlens.functions.markup import markdown_to_plain, rst_to_plain

# What counts as white space. Spark's trim() strips the space character only.
WHITE_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# The patterns that tell markdown from reStructuredText. The flags mean: ^ matches
# at line starts, only \n ends a line, and \s, \w, \S are Unicode-aware.
_FLAGS = "(?mdU)"
MARKDOWN_LINK = _FLAGS + r"\[[^\]]+\]\(http"
MARKDOWN_HEADING = _FLAGS + r"^\s*#{1,6}\s+\S"
RST_DIRECTIVE = _FLAGS + r"^\.\.\s+\w+::"
RST_UNDERLINE = _FLAGS + r"^[=\-`:\.'^~*+#]+(\r?\n)+"


def normalize(c: Column, remove_punct: bool = False, lowercase: bool = False, white_space: bool = False) -> Column:
    """Strip ASCII punctuation, lower-case, collapse and trim white space, each on request."""
    if remove_punct:
        c = F.regexp_replace(c, r"\p{Punct}", "")
    if lowercase:
        c = F.lower(c)
    if white_space:
        c = F.trim(F.regexp_replace(c, r"\s+", " "))
    return c


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def slug(owner: str, name: str) -> Column:
    """``owner/name``; null if a part is null."""
    return F.concat(F.col(owner), F.lit("/"), F.col(name))


def prefixed_reason(owner: str, name: str, reason: str) -> Column:
    """``owner/name: reason``; null if a part is null."""
    return F.concat(slug(owner, name), F.lit(": "), F.col(reason))


def first_lines(c: Column, lines: int = 500) -> Column:
    # substring_index scans for the n-th newline and copies once; no array of lines is built.
    return F.substring_index(c, "\n", lines)


def first_words(c: Column, words: int = 10_000) -> Column:
    return F.array_join(F.slice(F.split(strip(c), _SPACE_RUN), 1, words), " ")


def truncate_message(c: Column, lines: int = 500, words: int = 10_000) -> Column:
    """First ``lines`` lines, then the first ``words`` words joined by single spaces."""
    return first_words(first_lines(c, lines), words)


def guess_markup(c: Column) -> Column:
    """``markdown``, ``rst`` or ``unknown``: two tests per format, the higher score wins."""
    def hit(pattern: str, needs: str | None = None) -> Column:
        # A plain search for what any match contains saves most texts the pattern.
        found = c.rlike(pattern) if needs is None else c.contains(needs) & c.rlike(pattern)
        return found.cast("int")

    markdown = hit(MARKDOWN_LINK, "](http") + hit(MARKDOWN_HEADING, "#")
    rst = hit(RST_DIRECTIVE, "::") + hit(RST_UNDERLINE)
    return F.when(markdown > rst, "markdown").when(rst > markdown, "rst").otherwise("unknown")


def to_plain(c: Column) -> Column:
    """Plain text by guessed format; text of unknown format stays as it is."""
    kind = guess_markup(c)
    return F.when(kind == "markdown", markdown_to_plain(c)).when(kind == "rst", rst_to_plain(c)).otherwise(c)


def text_from_bytes(c: Column) -> Column:
    """UTF-8 text with ``\\n`` line ends; null when the bytes are not valid UTF-8."""
    return F.regexp_replace(F.try_validate_utf8(c.cast("string")), r"\r\n?", "\n")


def sanitize_utf8(c: Column) -> Column:
    """Replace invalid byte sequences so that any later encoder accepts the text."""
    return F.make_valid_utf8(c)


def remote_parts(url: Column, legacy: bool = False) -> tuple[Column, Column]:
    """(owner, repo) of an https or ssh remote; null where the address has no such parts.

    A ``.git`` suffix is removed from the repo; ``legacy`` removes ``.git`` wherever it stands.
    """
    https = F.split(url, "/")
    ssh = F.split(F.get(F.split(url, ":"), F.lit(1)), "/")
    is_https = url.startswith("https://")
    owner = F.when(is_https, F.try_element_at(https, F.lit(-2))).otherwise(F.get(ssh, F.lit(0)))
    repo = F.when(is_https, F.try_element_at(https, F.lit(-1))).otherwise(F.get(ssh, F.lit(1)))
    # One part missing means the whole address is malformed.
    repo = F.regexp_replace(repo, r"\.git" if legacy else r"\.git$", "")
    return F.when(repo.isNotNull(), owner), F.when(owner.isNotNull(), repo)


def fill(template: str, **values: Column) -> Column:
    """A ``{name}`` template over columns; a null value prints as ``None``."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        pieces += [F.lit(head), F.coalesce(values[name].cast("string"), F.lit("None"))]
    return F.concat(*pieces, F.lit(rest))


def data_uri(content: Column, media_type: str = "image/png") -> Column:
    """``data:`` address of a binary column; Spark's base64 wraps lines, an address may not."""
    return F.concat(F.lit(f"data:{media_type};base64,"), F.regexp_replace(F.base64(content), r"[\r\n]", ""))
