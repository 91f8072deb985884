"""Personal data by weak supervision: labelers vote on candidate spans, built-in functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlens.llm.common import fresh
from commitlens.llm.scans import largest_before, replaced, running, smallest_behind, sums_before
from commitlens.session import written

# The kinds every text is searched for, and those the method adds, in the order of results.
BASE = ["email", "ip", "card", "phone"]
ADDED = ["handle", "iban", "local_phone", "national_id", "secret"]
KINDS = BASE + ADDED

# What a candidate looks like. The first four find exactly what these do, leftmost first, without
# the recursion that Java's repeated groups need on long runs:
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+
#   phone \+[0-9][\x20().0-9-]+[0-9]
# \G lets a match begin right where the one before it ended, inside a run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-](?:[A-Za-z0-9.-](?<!\.\.))*(?<!\.)",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[0-9\x20-](?<![\x20-][\x20-]))+(?<=[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "handle": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{2,63}+ ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,24}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9+().-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])",
}
# What a text must hold for the pattern to be tried.
_GATES = {
    "email": "contains({t}, '@')",
    "ip": r"{t} RLIKE r'[0-9]\.[0-9]'",
    "card": "{t} RLIKE '[0-9]'",
    "phone": "contains({t}, '+')",
    "handle": r"{t} RLIKE r'(?:\)|\]| )dot|\(dot|\[dot'",
    "iban": "{t} RLIKE '[A-Z]{{2}}[0-9]{{2}}'",
    "local_phone": "{t} RLIKE '[0-9]{{4}}'",
    "national_id": "{t} RLIKE '-[0-9]{{2}}-'",
    "secret": "{t} RLIKE '[A-Za-z0-9+/_-]{{20}}'",
}
# Numbers with fewer digits are no candidates for a card that fails its check.
_LEAST_DIGITS = 8

# Gazetteers: endings of host names, card issuers, country codes, countries of bank accounts,
# beginnings of well-known access tokens.
HOSTS = "com org net edu gov int info io dev app co biz me eu uk de fr es it nl be ch at pl pt se no fi dk cz ru cn jp in br mx us ca au".split()
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|62)"
COUNTRY_CODES = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-9][0-9]|3[578][0-9]|42[0-9]|[5689][0-9]{2})"
BANK_COUNTRIES = "AD AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK SM".split()
TOKEN_STARTS = "^(?:AKIA|ASIA|ghp_|gho_|github_pat_|glpat-|sk_|pk_|sk-|xox[abp]-|AIza|eyJ|ya29)"
# Words before a span that speak for its kind, and those that speak for some other number.
CUES = {
    "email": "mail|contact|write|address|correo|courriel|adresse|kontakt",
    "ip": r"\bip\b|host|server|address|gateway|login",
    "card": "card|visa|master|amex|pay|karte|carte|tarjeta|credit",
    "phone": r"phone|\btel|call|fax|mobil|whatsapp|telefon|téléphone|teléfono",
    "handle": "mail|contact|write|reach",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "local_phone": r"phone|\btel|call|fax|mobil|whatsapp|telefon|téléphone|teléfono",
    "national_id": r"ssn|social|security|\bid\b|passport|ausweis",
    "secret": r"token|key|secret|passw|pwd|auth|bearer|credential|api",
}
DOUBTS = r"(?:version|\bv|figure|fig|section|chapter|isbn|issn|doi|page|pp|row|sha|commit|md5|hash|checksum)[\s.:#=]*$"

VOTES = ["form", "gazetteer", "cue", "doubt", "apart"]
SHAPES = ["kind", "length", "digits", "before", "after"]
_ITEM = (
    "struct<kind:string,start:bigint,end:bigint,base:boolean,form:int,gazetteer:int,cue:int,doubt:int,apart:int,"
    "length:int,digits:int,before:int,after:int>"
)


def _text(value: str) -> str:
    """SQL for a string."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _any_of(values: list[str], c: str) -> str:
    return f"{c} IN ({', '.join(map(_text, values))})"


_DIGITS = "regexp_replace(x.hit, '[^0-9]', '')"
_LUHN = """aggregate(sequence(1, length({d})), 0, (s, i) -> s + IF(i % 2 = 0,
    IF(cast(substring({d}, -i, 1) AS int) > 4, 2 * cast(substring({d}, -i, 1) AS int) - 9, 2 * cast(substring({d}, -i, 1) AS int)),
    cast(substring({d}, -i, 1) AS int))) % 10 = 0""".replace("{d}", _DIGITS)
_PART = "trim(LEADING '0' FROM p)"

# SQL over a match ``x.hit``: which matches of a base kind are personal data.
CHECKS = {
    "email": "true",
    "ip": f"forall(split(x.hit, '[.]'), p -> length({_PART}) <= 3 AND coalesce(try_cast({_PART} AS int), 0) <= 255)",
    "card": f"IF(length({_DIGITS}) BETWEEN 14 AND 19, {_LUHN}, false)",
    "phone": f"length({_DIGITS}) BETWEEN 10 AND 15",
}


def _vote(yes: str, no: str = "0") -> str:
    return f"IF({yes}, 1, {no})"


def _forms(kind: str) -> str:
    """The regular-expression labeler: does the match have the form its kind must have?"""
    return {
        "email": _vote(r"x.hit RLIKE r'^[A-Za-z0-9][^@]*@.*\.[A-Za-z]{2,24}$'", "-1"),
        "handle": "1",
        "iban": _vote("length(replace(x.hit, ' ', '')) BETWEEN 15 AND 34", "-1"),
        "local_phone": _vote(r"x.hit RLIKE r'^\(?[2-9]'"),
        "national_id": _vote("NOT x.hit RLIKE '^(?:000|666|9)|-00-|-0000$'", "-1"),
        "secret": _vote("x.hit RLIKE '[0-9]' AND x.hit RLIKE '[A-Za-z]'", "-1"),
    }.get(kind) or _vote(CHECKS[kind], "-1")


def _gazetteers(kind: str) -> str:
    return {
        "email": _vote(_any_of(HOSTS, r"lower(regexp_extract(x.hit, r'\.([A-Za-z0-9-]+)$', 1))")),
        "ip": _vote("x.hit RLIKE '^(?:0|127|25[0-9])[.]'", "0").replace("1, 0", "-1, 0"),
        "card": _vote(f"{_DIGITS} RLIKE {_text(ISSUERS)}"),
        "phone": _vote(f"{_DIGITS} RLIKE {_text(COUNTRY_CODES)}"),
        "handle": _vote(_any_of(HOSTS, "lower(regexp_extract(x.hit, '([A-Za-z]+)$', 1))")),
        "iban": _vote(_any_of(BANK_COUNTRIES, "substring(x.hit, 1, 2)"), "-1"),
        "local_phone": "0",
        "national_id": "0",
        "secret": _vote(f"x.hit RLIKE {_text(TOKEN_STARTS)} OR (x.hit RLIKE '^[0-9a-f]+$' AND length(x.hit) IN (32, 40, 48, 64, 96, 128))"),
    }[kind]


def _side(c: str) -> str:
    """A neighbouring character's class: none, white space, letter or digit, quote or bracket, other."""
    classes = [(r"\s", 1), (r"[\p{L}\p{N}_]", 2), ("[\"'<>()\\[\\]]", 3)]
    return f"CASE WHEN {c} = '' THEN 0 " + " ".join(f"WHEN {c} RLIKE {_text(p)} THEN {n}" for p, n in classes) + " ELSE 4 END"


def _candidates(kind: str, t: str) -> str:
    """SQL: the kind's candidates in ``t``, with places in code points, votes and shape."""
    pattern = _text(PATTERNS[kind])
    before, after = "right(x.piece, 1)", "substring(x.next, 1, 1)"
    left = "lower(right(x.piece, 40))"
    wanted = f"length({_DIGITS}) >= {_LEAST_DIGITS}" if kind == "card" else "true"
    base = CHECKS.get(kind, "false")
    alnum = r"r'[\p{L}\p{N}_]'"
    item = f"""named_struct(
                'kind', '{kind}',
                'start', x.at,
                'end', x.at + length(x.hit),
                'base', {base},
                'form', {_forms(kind)},
                'gazetteer', {_gazetteers(kind)},
                'cue', {_vote(f"{left} RLIKE {_text(CUES[kind])}")},
                'doubt', IF({left} RLIKE {_text(DOUBTS)}, -1, 0),
                'apart', IF({before} RLIKE {alnum} OR {after} RLIKE {alnum}, -1, 0),
                'length', cast(log2(length(x.hit)) * 2 AS int),
                'digits', cast(4 * length({_DIGITS}) / length(x.hit) AS int),
                'before', {_side(before)},
                'after', {_side(after)})"""
    # Every match with the text before it, its place, and the text behind it.
    starts = sums_before("zip_with(hits, slice(pieces, 1, size(hits)), (h, p) -> cast(length(p) + length(h) AS bigint))")
    placed = f"""zip_with(zip_with(hits, pieces, (h, p) -> named_struct('hit', h, 'piece', p)),
            zip_with({starts}, slice(pieces, 2, size(pieces)), (a, n) -> named_struct('a', a, 'next', n)),
            (y, z) -> named_struct('hit', y.hit, 'piece', y.piece, 'at', z.a + length(y.piece), 'next', z.next))"""
    wanted_ones = f"filter({placed}, x -> x.hit IS NOT NULL AND {wanted})"
    none = f"cast(array() AS array<{_ITEM}>)"
    # Most texts that pass a gate have no match; only those that do are split as well.
    return f"""IF(coalesce({_GATES[kind].format(t=t)}, false), transform(array(regexp_extract_all({t}, {pattern}, 0)), hits -> IF(size(hits) = 0, {none},
        transform(array(split({t}, {pattern}, -1)), pieces -> transform({wanted_ones}, x -> {item}))[0]))[0], {none})"""


def with_candidates(docs: DataFrame, column: str, text_column: str = "text") -> DataFrame:
    """``docs`` with an array column of all candidate spans, one kind after the other; null text: none."""
    quoted = f"coalesce(`{text_column}`, '')"
    return docs.withColumn(column, F.expr("concat(" + ",\n".join(_candidates(k, quoted) for k in KINDS) + ")"))


# -- learning ------------------------------------------------------------------------------------


@dataclass
class Model:
    """How far each labeler is right, and the weights of the span classifier, in log odds."""

    reliability: dict[str, float] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0

    def accepts(self, item: str) -> str:
        """SQL: is the candidate personal data, by the sum of its features' weights?"""
        terms = [
            f"CASE concat('{f}=', {item}.{f}) " + " ".join(f"WHEN {_text(k)} THEN {w!r}D" for k, w in own) + " ELSE 0D END"
            for f in VOTES + SHAPES
            if (own := [(k, w) for k, w in sorted(self.weights.items()) if k.startswith(f"{f}=")])
        ]
        return f"({' + '.join([f'{self.bias!r}D', *terms])} > 0)"


def fit(candidates: DataFrame, column: str, rounds: int = 10) -> Model:
    """Learn from all candidates of a corpus.

    Candidates are counted by votes and shape first; that table's size is bounded by the number
    of such patterns, whatever the corpus. Expectation: a pattern's probability from the labelers'
    reliabilities and its kind's prior; maximisation: both anew, as one aggregation over the
    patterns. The probabilities then train the classifier: smoothed log odds of every vote and
    shape feature. Without candidates the model accepts nothing that it has not seen.
    """
    every = candidates.select(F.explode(column).alias("c")).select("c.*")
    patterns = written(every.groupBy(*VOTES, *SHAPES).agg(F.count(F.lit(1)).cast("double").alias("n")), "patterns")
    right = dict.fromkeys(VOTES, 0.8)
    prior = dict.fromkeys(KINDS, 0.5)

    def odds(p: float) -> float:
        return math.log(p / (1 - p))

    def posterior():
        start = F.coalesce(*(F.when(F.col("kind") == k, F.lit(odds(p))) for k, p in prior.items()), F.lit(0.0))
        total = sum((F.col(v) * odds(a) for v, a in right.items()), start)
        return 1 / (1 + F.exp(-total))

    for _ in range(rounds):
        judged = patterns.withColumn("p", posterior())
        sums = [F.sum(F.when(F.col(v) == 1, F.col("n") * F.col("p")).when(F.col(v) == -1, F.col("n") * (1 - F.col("p")))).alias(f"hit_{v}") for v in VOTES]
        sums += [F.sum(F.when(F.col(v) != 0, F.col("n"))).alias(f"all_{v}") for v in VOTES]
        sums += [F.sum(F.when(F.col("kind") == k, F.col("n") * F.col("p"))).alias(f"yes_{k}") for k in KINDS]
        sums += [F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(f"of_{k}") for k in KINDS]
        s = judged.agg(*sums).first()
        # Smoothed; a labeler is never taken to be worse than a coin, so the classes cannot swap.
        right = {v: min(0.99, max(0.5, ((s[f"hit_{v}"] or 0) + 8) / ((s[f"all_{v}"] or 0) + 10))) for v in VOTES}
        prior = {k: min(0.99, max(0.01, ((s[f"yes_{k}"] or 0) + 1) / ((s[f"of_{k}"] or 0) + 2))) for k in KINDS}

    judged = patterns.withColumn("p", posterior())
    pairs = F.explode(F.array(*(F.concat(F.lit(f"{f}="), F.col(f)) for f in VOTES + SHAPES))).alias("feature")
    yes, no = F.sum(F.col("n") * F.col("p")), F.sum(F.col("n") * (1 - F.col("p")))
    counted = judged.select(pairs, "n", "p").groupBy("feature").agg(yes.alias("yes"), no.alias("no")).collect()
    total = judged.agg(yes.alias("yes"), no.alias("no")).first()
    all_yes, all_no = total.yes or 0.0, total.no or 0.0
    weights = {r.feature: math.log((r.yes + 1) / (all_yes + 2)) - math.log((r.no + 1) / (all_no + 2)) for r in counted}
    return Model(right, weights, math.log((all_yes + 1) / (all_no + 1)))


# -- spans ---------------------------------------------------------------------------------------

_ORDER = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
_SPAN = "struct<kind:string,start:bigint,end:bigint>"


def _sorted(spans: str) -> str:
    return f"""array_sort({spans}, (a, b) -> CASE WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1)
        ELSE cast(array_position({_ORDER}, a.kind) - array_position({_ORDER}, b.kind) AS int) END)"""


def _bare(items: str) -> str:
    return f"transform({items}, c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end))"


def base_spans(column: str) -> str:
    """SQL: the base kinds' spans by start, then kind."""
    return _sorted(_bare(f"filter({column}, c -> c.base)"))


def all_spans(column: str, model: Model) -> str:
    """SQL: base spans and the added candidates the model accepts that touch none of them.

    In order of their starts a span touches a base span before it if one of those ends behind its
    start, and one behind it if the next of those begins before its end.
    """
    added = f"c.kind NOT IN ({', '.join(map(_text, BASE))}) AND {model.accepts('c')}"
    ordered = f"""array_sort(transform(filter({column}, c -> c.base OR ({added})), c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'base', c.base)),
        (a, b) -> CASE WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1) WHEN a.base <> b.base THEN IF(a.base, -1, 1)
        ELSE cast(array_position({_ORDER}, a.kind) - array_position({_ORDER}, b.kind) AS int) END)"""
    ends = largest_before("transform(all, c -> IF(c.base, c.end, -1L))")
    starts = smallest_behind("transform(all, c -> IF(c.base, c.start, 9223372036854775807L))")
    clear = f"""transform(array({ordered}), all -> IF(size(all) < 2, transform(all, c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'kept', true)), filter(zip_with(all, zip_with({ends}, {starts}, (e, s) -> named_struct('e', e, 's', s)),
        (c, n) -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'kept', c.base OR NOT (n.e > c.start OR n.s < c.end))), c -> c.kept)))[0]"""
    return _sorted(_bare(clear))


def find_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, base, spans): personal data in every whole text, one row per row of ``docs``.

    ``base`` are the matches of the four base kinds that pass their checks, ``spans`` these and
    what the trained classifier adds; kind, start and end in code points, end exclusive. Texts are
    searched once; only candidates, without their text, are written and read again. A null text
    counts as empty, repeated rows give repeated rows, a null id stays null, an empty table gives
    no rows, and other columns are not read.
    """
    picked = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    found = written(with_candidates(picked, "candidates").select(id_column, "candidates"), "candidates")
    model = fit(found, "candidates")
    return found.select(
        id_column,
        F.expr(base_spans("candidates")).alias("base"),
        F.expr(all_spans("candidates", model)).alias("spans"),
    )


def listed(spans: str) -> str:
    """SQL: spans as kind:start:end, comma-joined."""
    return f"array_join(transform({spans}, c -> concat(c.kind, ':', c.start, ':', c.end)), ',')"


def span_digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of ``find_spans``."""
    return found.select(
        id_column,
        *(F.expr(f"cast(size(filter(base, c -> c.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in BASE),
        F.sha2(F.expr(listed("base")).cast("binary"), 256).alias("base_sha256"),
        F.expr(listed("spans")).alias("spans"),
    )


def mask(docs: DataFrame, text_column: str = "text", length_column: str | None = None) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets.

    Overlapping spans are replaced as one, by the first one's kind. The model is learned from the
    same rows. Rows, order of columns and all other columns stay as they are; a null text stays
    null. ``length_column`` gets the new number of code points, where the text is not null.
    """
    column = fresh(docs, "candidates")
    found = written(with_candidates(docs.select(F.col(text_column).alias("text")), "c").select("c"), "candidates")
    model = fit(found, "c")
    marked = with_candidates(docs, column, text_column)
    t = f"`{text_column}`"
    ends = running("transform(all, c -> c.end)", "-1L", "greatest({a}, {b})")
    # The first span of each run of spans that overlap, and how far the run reaches.
    heads = """filter(zip_with(all, before, (c, e) -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'before', e)), c -> c.start >= c.before)"""
    reach = "concat(transform(slice(heads, 2, size(heads)), h -> h.before), array(greatest(element_at(all, -1).end, element_at(before, -1))))"
    joined = f"zip_with(heads, {reach}, (h, e) -> named_struct('start', h.start, 'end', e, 'put', concat('[', upper(h.kind), ']')))"
    merged = f"""transform(array({all_spans(f"`{column}`", model)}), all -> IF(size(all) = 0, cast(array() AS array<struct<start:bigint,end:bigint,put:string>>),
        transform(array({ends}), before -> transform(array({heads}), heads -> {joined})[0])[0]))[0]"""
    masked = f"transform(array({t}), whole -> {replaced('whole', merged)})[0]"
    done = marked.withColumn(text_column, F.expr(f"IF({t} IS NULL OR size(`{column}`) = 0, {t}, {masked})"))
    if length_column:
        kind = docs.schema[length_column].dataType
        done = done.withColumn(length_column, F.coalesce(F.length(text_column).cast(kind), F.col(length_column)))
    return done.drop(column)
