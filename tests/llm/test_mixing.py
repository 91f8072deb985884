import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from commitlens.llm import mixing
from commitlens.llm.mixing import Mixture


def hashes(rows):
    """For rows of values the first fifteen hexadecimal digits of an MD5 sum, as a number."""
    return [int(hashlib.md5(":".join("null" if v is None else str(v) for v in r).encode()).hexdigest()[:15], 16) for r in rows]


def words(text):
    return sum(1 for w in (text or "").translate({c: 32 for c in range(9, 14)}).split(" ") if w)


def best_exponent(shares, goal, total):
    """Plain bisection on each limit."""

    def measure(a):
        z = sum(p**a for p in shares)
        w = [p**a / z for p in shares]
        h = -sum(x * math.log(x) for x in w) / math.log(len(shares)) if len(shares) > 1 else 1.0
        reps = [x / p for x, p in zip(w, shares, strict=True)]
        drawn = 1 / min(reps) if goal.budget is None else goal.budget / total
        return h, drawn * max(reps)

    def bisect(good_low, test):
        if good_low and test(1.0):
            return 1.0
        if not good_low and test(0.0):
            return 0.0
        if (good_low and not test(0.0)) or (not good_low and not test(1.0)):
            return 0.0 if good_low else 1.0
        low, high = 0.0, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            if test(mid) == good_low:
                low = mid
            else:
                high = mid
        return low

    return max(bisect(True, lambda a: measure(a)[0] >= goal.entropy), bisect(False, lambda a: measure(a)[1] <= goal.repeats))


@pytest.mark.parametrize(
    "goal",
    [Mixture(0.95, 50.0), Mixture(0.99, 1.5), Mixture(0.9, 2.0, budget=900.0), Mixture(0.1, 9.0), Mixture(1.0, 100.0), Mixture(0.99, 0.5, budget=5e3)],
)
def test_exponent(spark, goal):
    tokens = [500, 120, 60, 30, 10]
    total = sum(tokens)
    sources = spark.createDataFrame([(t / total, t) for t in tokens], "share double, tokens long")
    want = best_exponent([t / total for t in tokens], goal, total)
    assert mixing.exponent(sources, goal) == pytest.approx(want, abs=1e-5)


def documents():
    rng = random.Random(6)
    rows = []
    for i in range(700):
        source = rng.choice(["a"] * 12 + ["b"] * 4 + ["c", None, "d"])
        rows.append((i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 30, 31]))), source, i))
    rows += [(900, "rep eat " * 4, "a", 1)] * 150
    rows += [(None, "x y", "c", 2), (901, None, "c", 3), (902, "", "e", 4), (903, " \n", "e", 5), (904, "long " * 20_000, "b", 6)]
    return rows


@pytest.mark.parametrize("goal", [Mixture(0.9, 3.0, block_docs=16), Mixture(0.97, 4.0, budget=20_000.0, block_docs=8, seed=3)])
def test_mix_agrees_with_a_plain_walk(spark, goal):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int")
    key = dict(zip(ids := sorted({r[0] for r in rows}, key=repr), hashes([(goal.seed, i) for i in ids]), strict=True))
    tokens = Counter()
    count = Counter()
    for _, t, s, _ in rows:
        tokens[s] += words(t)
        count[s] += 1
    total = sum(tokens.values())
    spoken = [s for s in tokens if tokens[s]]
    alpha = mixing.exponent(spark.createDataFrame([(tokens[s] / total, tokens[s]) for s in spoken], "share double, tokens long"), goal)
    z = sum((tokens[s] / total) ** alpha for s in spoken)
    least = min((tokens[s] / total) ** (alpha - 1) for s in spoken)
    budget = goal.budget or total * z / least
    want = Counter()
    for s in tokens:
        n_blocks = -(-count[s] // goal.block_docs)
        own = [r for r in rows if r[2] == s]
        keys = sorted({key[r[0]] for r in own})
        block = {k: h % n_blocks for k, h in zip(keys, hashes([(goal.seed, "block", k) for k in keys]), strict=True)}
        members = defaultdict(list)
        for r in own:
            members[block[key[r[0]]]].append(r)
        if not tokens[s]:
            full, rest = 1, 0.0
        else:
            quota = budget * (tokens[s] / total) ** alpha / z
            full = math.floor(quota / tokens[s] + 1e-9)
            rest = quota - full * tokens[s]
            rest = rest if rest > 1e-9 * tokens[s] else 0.0
        for epoch in range(full + 1):
            if epoch == full and rest <= 0:
                continue
            names = sorted(members)
            order = [b for _, b in sorted(zip(hashes([(goal.seed, epoch, b) for b in names]), names, strict=True))]
            spent = 0
            for turn, b in enumerate(order, 1):
                size = sum(words(r[1]) for r in members[b])
                chosen = members[b]
                if epoch == full:
                    if spent >= rest:
                        break
                    if spent + size > rest:
                        in_block = sorted({key[r[0]] for r in chosen})
                        by_hash = [k for _, k in sorted(zip(hashes([(goal.seed, epoch, k) for k in in_block]), in_block, strict=True))]
                        left, allowed = rest - spent, set()
                        used = 0
                        for k in by_hash:
                            if used < left:
                                allowed.add(k)
                            used += sum(words(r[1]) for r in chosen if key[r[0]] == k)
                        chosen = [r for r in chosen if key[r[0]] in allowed]
                spent += size
                for r in chosen:
                    want[(*r, epoch, turn, words(r[1]))] += 1
    got = Counter((*r.doc, r.epoch, r.turn, r.n_tokens) for r in mixing.mix(docs, goal).collect())
    assert got == want
    if goal.budget is None:
        assert {k[:4] for k in got} == set(rows)
    drawn = mixing.mixed_documents(docs, goal)
    assert drawn.columns == docs.columns and drawn.count() == sum(want.values())


def test_empty_and_wordless(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema), Mixture()).collect() == []
    only = mixing.mixed_documents(spark.createDataFrame([(1, "", "a"), (2, None, None)], schema), Mixture()).collect()
    assert sorted(r.doc_id for r in only) == [1, 2]
