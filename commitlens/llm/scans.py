"""Running sums and the like over an array, as SQL, in pieces of about the root of its length.

Appending to an array in ``aggregate`` copies it every time, so a scan of n items would copy n * n / 2. Here
the pieces are scanned each by itself from where the pieces before them end, which copies n times the root of n.
"""

from __future__ import annotations


# Up to this many items appending is cheaper than cutting into pieces.
_FEW = 48


def _step(items: str, first: str, combine: str) -> str:
    """SQL: ``first`` and then what it combines to with one item after the other."""
    joined = combine.format(a="element_at(t, -1)", b="x")
    return f"aggregate({items}, array({first}), (t, x) -> concat(t, array({joined})))"


def running(items: str, first: str, combine: str) -> str:
    """SQL: for every item what ``first`` and all items before it combine to.

    ``items`` is an array; ``combine`` has {a} and {b} and does not care how items are grouped; ``first`` changes nothing.
    """
    whole = combine.format(a="y", b="x")
    return f"""transform(array({items}), a -> IF(size(a) <= {_FEW}, slice({_step("a", first, combine)}, 1, size(a)), transform(array(cast(ceil(sqrt(size(a))) AS int)), w ->
        transform(array(transform(sequence(0, cast(ceil(size(a) / w) AS int) - 1), k -> slice(a, k * w + 1, w))), parts ->
            flatten(zip_with(parts,
                slice({_step(f"transform(parts, p -> aggregate(p, {first}, (y, x) -> {whole}))", first, combine)}, 1, size(parts)),
                (p, s) -> slice({_step("p", "s", combine)}, 1, size(p)))))[0])[0]))[0]"""


def sums_before(items: str) -> str:
    return running(items, "0L", "{a} + {b}")


def largest_before(items: str) -> str:
    return running(items, "-1L", "greatest({a}, {b})")


def smallest_behind(items: str) -> str:
    return f"reverse({running(f'reverse({items})', '9223372036854775807L', 'least({a}, {b})')})"


def replaced(text: str, spans: str) -> str:
    """SQL: ``text`` with every span (start, end, put), sorted and apart from each other, replaced by what to put there.

    A substring is found by walking from the text's start, so the text is first cut into stretches of about
    the root of the number of spans, and the spans in their own stretch.
    """
    stretch = f"""transform(array(substring({text}, cast(c[0].from + 1 AS int), cast(element_at(c, -1).start - c[0].from AS int))), part ->
        array_join(transform(c, x -> concat(substring(part, cast(x.from - c[0].from + 1 AS int), cast(x.start - x.from AS int)), x.put)), ''))[0]"""
    return f"""transform(array({spans}), s -> IF(size(s) = 0, {text}, transform(array(cast(ceil(sqrt(size(s))) AS int)), w ->
        transform(array(zip_with(s, slice(concat(array(0L), transform(s, x -> x.end)), 1, size(s)),
            (x, f) -> named_struct('from', f, 'start', x.start, 'put', x.put))), every ->
            concat(array_join(transform(
                transform(sequence(0, cast(ceil(size(every) / w) AS int) - 1), k -> slice(every, k * w + 1, w)), c -> {stretch}), ''),
                substring({text}, cast(element_at(s, -1).end + 1 AS int))))[0])[0]))[0]"""
