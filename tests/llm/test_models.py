"""The composed grammar and the segment decoder against brute force."""

import itertools
import math
import random

import pytest

from pointcluster.llm import pii, toxicity

TAGS = range(7)
REACH = toxicity.REACH


def one_after_another(tags):
    """The four stages as plain loops over whole clauses; ``[(tag, factor)]``."""
    out = [[t, 1.0] for t in tags]
    # a negation works on the next REACH tokens
    since = None
    for cell in out:
        tag = cell[0]
        if tag == toxicity.NEGATION:
            since = 0
            continue
        since = None if since is None else since + 1
        if since is not None and since <= REACH:
            if tag == toxicity.INSULT:
                cell[1] *= 0.2
            elif tag == toxicity.THREAT:
                cell[0], cell[1] = toxicity.OTHER, 0.0
    # whatever follows reported speech counts half
    reported = False
    for cell in out:
        if reported and cell[0] in (toxicity.INSULT, toxicity.THREAT):
            cell[1] *= 0.5
        reported = reported or cell[0] == toxicity.REPORT
    # an insult within REACH tokens after a target counts more
    since = None
    for cell in out:
        if cell[0] == toxicity.TARGET:
            since = 0
            continue
        since = None if since is None else since + 1
        if since is not None and since <= REACH and cell[0] == toxicity.INSULT:
            cell[1] *= 1.5
    # a threat word is silent; the first target within REACH tokens says it
    since = None
    for cell in out:
        if cell[0] == toxicity.THREAT:
            since, cell[0] = 0, toxicity.OTHER
            continue
        since = None if since is None else since + 1
        if since is not None and since <= REACH and cell[0] == toxicity.TARGET:
            cell[0], since = toxicity.THREAT, None
    return [tuple(c) for c in out]


def composed(machine, tags):
    state, out = 0, []
    for tag in tags:
        state, tag, factor = machine.step(state, tag)
        out.append((tag, factor))
    return out


def test_composed_grammar_equals_its_stages():
    machine = toxicity.grammar()
    rng = random.Random(8)
    clauses = [c for n in range(5) for c in itertools.product(TAGS, repeat=n)]
    clauses += [tuple(rng.choices(TAGS, k=rng.randint(5, 30))) for _ in range(20_000)]
    for tags in clauses:
        got, want = composed(machine, tags), one_after_another(tags)
        assert [t for t, _ in got] == [t for t, _ in want], tags
        assert [f for _, f in got] == pytest.approx([f for _, f in want]), tags


def segmentations(n, cands):
    """Every set of candidates that do not overlap, by where they begin."""
    if n == 0:
        yield []
        return
    yield from segmentations(n - 1, cands)
    for x, c in enumerate(cands):
        if c[1] == n:
            for rest in segmentations(c[0], cands):
                yield [*rest, x]


def random_island(rng):
    n = rng.randint(1, 7)
    cands = [
        (i, j, 10 * i, 10 * j, rng.sample("abcdef", rng.randint(0, 4)))
        for i in range(n)
        for j in range(i + 1, min(n, i + pii.MAX_TOKENS) + 1)
        if rng.random() < 0.7
    ]
    return n, cands


def random_field(rng):
    return pii.Field({f: [rng.uniform(-2, 5) for _ in pii.KINDS] for f in "abcde"})


def test_decoder_finds_the_best_segmentation():
    rng = random.Random(6)
    found = 0
    for _ in range(400):
        field, (n, cands) = random_field(rng), random_island(rng)
        best = max(
            sum(max(field.scores(cands[x][4])) for x in some) for some in segmentations(n, cands)
        )
        got = field.decode(n, cands)
        place = {(c[2], c[3]): c for c in cands}
        total = sum(
            field.scores(place[(lo, hi)][4])[pii.KINDS.index(kind)] for lo, hi, kind in got
        )
        assert total == pytest.approx(best)
        ends = sorted((lo, hi) for lo, hi, _ in got)
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
        found += len(got)
    assert found > 200


def test_learning_climbs_the_likelihood_over_all_segmentations():
    rng = random.Random(3)
    examples = []
    while len(examples) < 25:
        n, cands = random_island(rng)
        # segments with feature "a" are secrets, those with "b" but not "a" are nothing
        gold, end = {}, 0
        for x, c in sorted(enumerate(cands), key=lambda v: v[1][:2]):
            if "a" in c[4] and c[0] >= end:
                gold[x], end = pii.KINDS.index("secret"), c[1]
        examples.append((n, cands, gold))

    def likelihood(field):
        total = 0.0
        for n, cands, gold in examples:
            scores = [field.scores(c[4]) for c in cands]
            whole = sum(
                math.prod(sum(map(math.exp, scores[x])) for x in some)
                for some in segmentations(n, cands)
            )
            total += sum(scores[x][k] for x, k in gold.items()) - math.log(whole)
        return total

    field = pii.Field()
    seen = [likelihood(field)]
    for _ in range(3):
        field.learn(examples, epochs=2)
        seen.append(likelihood(field))
    assert seen[0] < seen[1] < seen[-1] and seen[-1] < 0
