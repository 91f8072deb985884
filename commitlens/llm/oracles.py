"""The queries that SQL can state, as SQL over the same tables."""

from __future__ import annotations

from commitlens.llm import licenses, mixing


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _spaced(pattern: str) -> str:
    """A rule's pattern for words that each have a space before and one behind them."""
    optional = "\x01"
    return pattern.replace(" ?", optional).replace(" ", "  ").replace(optional, "(?:  )?")


def license_labels() -> str:
    """All rules over all texts that hold their keyword, then containment between pairs of detections."""
    every = [("rule", i, r) for i, r in enumerate(licenses.rules())]
    every += [("base", i, licenses.Rule(p, p, label, 0, 0.8)) for i, (p, label) in enumerate(licenses.BASE.items())]
    rows = ",\n".join(
        f"('{kind}', {i}, {_text(r.keyword)}, {_text(' (?:' + _spaced(r.pattern) + ') ')}, {_text(r.label)}, {r.tier}, CAST({r.confidence} AS DOUBLE))"
        for kind, i, r in every
    )
    words = "CAST((length({0}) - length(replace({0}, ' ', ''))) // 2 AS BIGINT)"
    return rf"""
        WITH rules(kind, number, keyword, pattern, label, tier, confidence) AS (VALUES {rows}),
        split AS (
          SELECT doc_id, [x for x in string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS l
          FROM documents),
        spaced AS (SELECT doc_id, array_to_string(l, ' ') AS single, ' ' || array_to_string(l, '  ') || ' ' AS double FROM split),
        found AS (
          SELECT doc_id, rules.*, regexp_extract_all(double, pattern) AS hits, string_split_regex(double, pattern) AS pieces
          FROM spaced JOIN rules ON contains(single, keyword)),
        each AS (
          SELECT doc_id, kind, number, label, tier, confidence, unnest(range(len(hits))) AS i, unnest(hits) AS hit,
                 unnest(list_slice(pieces, 1, len(hits))) AS piece
          FROM found WHERE len(hits) > 0),
        placed AS (
          SELECT *, {words.format("hit")} AS size,
                 CAST(sum({words.format("piece")} + {words.format("hit")}) OVER (PARTITION BY doc_id, kind, number ORDER BY i) AS BIGINT) AS stop
          FROM each),
        d AS (SELECT doc_id, kind, number, label, tier, confidence, stop - size AS start, stop FROM placed),
        kept AS (
          SELECT * FROM d WHERE kind = 'base' OR NOT EXISTS (
            SELECT 1 FROM d AS e
            WHERE e.kind = 'rule' AND e.doc_id = d.doc_id AND e.start <= d.start AND e.stop >= d.stop AND e.tier <= d.tier
              AND (e.start < d.start OR e.stop > d.stop OR e.tier < d.tier OR (e.tier = d.tier AND e.number < d.number)))),
        summed AS (
          SELECT doc_id, count(*) FILTER (WHERE kind = 'base') AS n_base, min(start) FILTER (WHERE kind = 'base') AS first_word,
                 max(start) FILTER (WHERE kind = 'base') AS last_word,
                 string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE kind = 'base') AS base_labels,
                 string_agg(DISTINCT label, ',' ORDER BY label) AS labels, round(1 - product(1 - confidence), 6) AS score
          FROM kept GROUP BY doc_id)
        SELECT split.doc_id, CAST(len(l) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
        FROM split LEFT JOIN summed ON summed.doc_id = split.doc_id"""


def _hashed(*parts: str) -> str:
    texts = " || ':' || ".join(f"coalesce(CAST({p} AS VARCHAR), 'null')" for p in parts)
    return f"CAST('0x' || substr(md5({texts}), 1, 15) AS BIGINT)"


def _border(name: str, low_side: bool, test: str, goal: mixing.Mixture) -> str:
    """Bisection as a recursive table: each pass a grid of exponents over the sources' shares."""
    grid = mixing._GRID
    return f"""
        {name}_steps(pass, low, high, done) AS (
          SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE), false
          UNION ALL
          SELECT pass + 1, CASE WHEN turn = 0 THEN points[1] WHEN turn > {grid} THEN points[{grid + 1}] ELSE points[turn] END,
                 CASE WHEN turn = 0 THEN points[1] WHEN turn > {grid} THEN points[{grid + 1}] ELSE points[turn + 1] END,
                 turn = 0 OR turn > {grid}
          FROM (SELECT pass, points, coalesce(list_position([CASE WHEN ({test}) = {str(low_side).lower()} THEN 0 ELSE 1 END for m in measures], 1) - 1, {grid + 1}) AS turn
                FROM (SELECT pass, points, [{{
                          'entropy': CASE WHEN n > 1 THEN (ln(list_sum([pow(x, a) for x in shares])) - a * list_sum([pow(x, a) * ln(x) for x in shares])
                              / list_sum([pow(x, a) for x in shares])) / ln(n) ELSE 1 END,
                          'repeats': {goal.budget} / total * list_max([pow(x, a - 1) for x in shares]) / list_sum([pow(x, a) for x in shares])
                        }} for a in points] AS measures
                      FROM (SELECT pass, [low + (high - low) * i / {grid} for i in range({grid + 1})] AS points FROM {name}_steps
                            WHERE NOT done AND pass < {mixing._PASSES}), listed))),
        {name} AS (SELECT {"low" if low_side else "high"} AS a FROM {name}_steps ORDER BY pass DESC LIMIT 1)"""


def mixed_documents() -> str:
    """The whole mixture: shares, exponent, quotas, block orders and the cut in the last block."""
    goal = mixing.Mixture(entropy=0.92, repeats=2.0, budget="total")
    seed = goal.seed
    return rf"""
        WITH RECURSIVE docs AS (
          SELECT doc_id, source, len([x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> '']) AS tokens,
                 {_hashed(str(seed), "doc_id")} AS key
          FROM documents),
        totals AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS docs FROM docs GROUP BY source),
        shared AS (SELECT *, tokens / CAST(sum(tokens) OVER () AS DOUBLE) AS share FROM totals),
        listed AS (SELECT list(share ORDER BY share) AS shares, count(*) AS n, CAST(sum(tokens) AS DOUBLE) AS total FROM shared WHERE tokens > 0),
        {_border("by_entropy", True, f"m.entropy >= {goal.entropy} - 1e-12", goal)},
        {_border("by_repeats", False, f"m.repeats <= {goal.repeats} + 1e-9", goal)},
        chosen AS (SELECT greatest(by_entropy.a, by_repeats.a) AS a FROM by_entropy, by_repeats),
        quotas AS (
          SELECT source, tokens, docs, total * pow(share, a) / list_sum([pow(x, a) for x in shares]) AS quota FROM shared, listed, chosen),
        plan AS (
          SELECT source, CAST(ceil(docs / {goal.block_docs}) AS BIGINT) AS blocks,
                 CASE WHEN tokens > 0 THEN CAST(floor(quota / tokens + 1e-9) AS BIGINT) ELSE 1 END AS whole,
                 CASE WHEN tokens > 0 AND quota - floor(quota / tokens + 1e-9) * tokens > tokens * 1e-9
                      THEN quota - floor(quota / tokens + 1e-9) * tokens ELSE 0 END AS rest
          FROM quotas),
        placed AS (
          SELECT docs.*, whole, rest, {_hashed(str(seed), "'block'", "key")} % blocks AS block
          FROM docs JOIN plan ON docs.source IS NOT DISTINCT FROM plan.source),
        blocks AS (SELECT source, block, any_value(whole) AS whole, any_value(rest) AS rest, sum(tokens) AS tokens FROM placed GROUP BY source, block),
        epochs AS (SELECT *, unnest(range(whole + 1)) AS epoch FROM blocks),
        ordered AS (SELECT *, {_hashed(str(seed), "epoch", "block")} AS h FROM epochs),
        turns AS (
          SELECT *, row_number() OVER w AS turn, coalesce(sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM ordered WINDOW w AS (PARTITION BY source, epoch ORDER BY h, block)),
        taken AS (
          SELECT *, CASE WHEN epoch = whole AND before + tokens > rest THEN rest - before END AS cut
          FROM turns WHERE epoch < whole OR (rest > 0 AND before < rest)),
        keys AS (SELECT source, block, key, sum(tokens) AS tokens FROM placed GROUP BY source, block, key),
        inside AS (
          SELECT taken.source, taken.block, epoch, key, cut, coalesce(sum(keys.tokens) OVER (
                   PARTITION BY taken.source, taken.block ORDER BY {_hashed(str(seed), "epoch", "key")}, key
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent
          FROM taken JOIN keys ON taken.source IS NOT DISTINCT FROM keys.source AND taken.block = keys.block
          WHERE cut IS NOT NULL)
        SELECT doc_id, placed.source, CAST(taken.epoch AS INTEGER) AS epoch, CAST(turn AS INTEGER) AS turn, CAST(placed.tokens AS BIGINT) AS n_tokens
        FROM placed JOIN taken ON placed.source IS NOT DISTINCT FROM taken.source AND placed.block = taken.block
        LEFT JOIN inside ON inside.source IS NOT DISTINCT FROM placed.source AND inside.block = placed.block
          AND inside.epoch = taken.epoch AND inside.key = placed.key
        WHERE taken.cut IS NULL OR inside.spent < taken.cut"""


def fill_in_middle(rate: int = 50, spm_rate: int = 80, seed: int = 42) -> str:
    """Tokens as a list, cut and joined again; the restored text is the text."""
    return rf"""
        WITH drawn AS (
          SELECT doc_id, coalesce(text, '') AS text, sha256('{seed}:' || CAST(doc_id AS VARCHAR)) AS h,
                 regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
          FROM documents),
        numbers AS (
          SELECT *, CAST(len(tokens) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                 CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
          FROM drawn),
        cuts AS (
          SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN h IS NULL OR text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {rate}
                      THEN 'plain' WHEN h4 % 100 < {spm_rate} THEN 'spm' ELSE 'psm' END AS form
          FROM numbers),
        pieces AS (
          SELECT *, array_to_string(tokens[1:a], '') AS p, array_to_string(tokens[a + 1:b], '') AS m, array_to_string(tokens[b + 1:], '') AS s
          FROM cuts)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM pieces"""


def vector_codes(parts: int = 16, size: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """Every part against every entry of its position, round by round."""

    def nearest(name: str, book: str) -> str:
        return f"""{name} AS MATERIALIZED (
          SELECT v.vec_id, v.p, any_value(v.part) AS part, min(list_sum(list_transform(range(1, v.w + 1),
                 lambda i: (v.part[i] - c.part[i]) * (v.part[i] - c.part[i]))) * {size} + c.entry) AS best
          FROM vectors v JOIN {book} c ON v.p = c.p GROUP BY v.vec_id, v.p)"""

    steps, book = [], "book0"
    for r in range(1, rounds + 1):
        steps.append(nearest(f"near{r}", book))
        steps.append(f"""book{r} AS MATERIALIZED (
          SELECT c.p, c.entry, c.w, coalesce(any_value(m.part), c.part) AS part FROM {book} c LEFT JOIN (
            SELECT p, entry, list(mean ORDER BY i) AS part FROM (
              SELECT p, best % {size} AS entry, i, CAST(floor(sum(part[i]) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS mean
              FROM (SELECT p, best, part, unnest(range(1, len(part) + 1)) AS i FROM near{r}) GROUP BY p, entry, i) GROUP BY p, entry) m
          ON c.p = m.p AND c.entry = m.entry GROUP BY c.p, c.entry, c.w, c.part)""")
        book = f"book{r}"
    steps.append(nearest("last", book))
    return f"""
        WITH kept AS MATERIALIZED (
          SELECT vec_id, label, len(embedding) // {parts} AS w,
                 list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        vectors AS MATERIALIZED (
          SELECT vec_id, label, w, p, list_slice(v, p * w + 1, (p + 1) * w) AS part
          FROM (SELECT *, unnest(range({parts})) AS p FROM kept)),
        book0 AS MATERIALIZED (
          SELECT p, entry, vectors.w, part FROM vectors JOIN (
            SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {size}) USING (vec_id)),
        {", ".join(steps)},
        coded AS (
          SELECT vec_id, string_agg(printf('%02x', CAST(best % {size} AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best // {size}) AS BIGINT) AS error
          FROM last GROUP BY vec_id),
        named AS (SELECT coded.*, label FROM coded JOIN kept USING (vec_id))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, entry)) FROM {book}) AS codebooks_sha256
        FROM named"""


ORACLES = {
    "op3_licenses": license_labels(),
    "op7_mixing": mixed_documents(),
    "op11_fim": fill_in_middle(),
    "op13_codes": vector_codes(),
}
