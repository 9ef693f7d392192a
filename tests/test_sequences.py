"""Visit statistics: hand-made cases and a random comparison with a plain scan."""

import random

from sparkmine.operators import sequences as S


def _visits(spark, seqs):
    rows = [(u, p, c) for u, s in enumerate(seqs) for p, c in enumerate(s)]
    return spark.createDataFrame(rows, "user_id long, pos long, category long")


def _emissions(spark, seqs, mode, cat=1):
    df = S.refresh_emissions(_visits(spark, seqs), mode=mode).filter(f"category = {cat}")
    out = {}
    for r in df.collect():
        out.setdefault(r.user_id, []).append(r.emitted)
    return [sorted(out.get(u, [])) for u in range(len(seqs))]


def test_refresh_hand_cases(spark):
    seqs = [[1, 2, 1], [1, 2, 2, 1], [1, 1, 1, 1], [1, 2, 1, 1]]
    assert _emissions(spark, seqs, "carry") == [[1], [1], [3], [2]]
    assert _emissions(spark, seqs, "runs") == [[], [], [3], [1]]


def test_revisit_hand_cases(spark):
    df = S.revisit_distances(_visits(spark, [[1, 2, 2, 1], [1, 1]])).filter("category = 1")
    assert [(r.user_id, r.distance) for r in df.collect()] == [(0, 2)]


def _scan_carry(seq, cat):
    """Counter of visits to ``cat`` that is only emptied at a foreign page once it
    reached two; each emptying (and the end) emits count - 1."""
    out, count = [], 0
    for x in seq + [None]:
        if x == cat:
            count += 1
        elif count >= 2:
            out.append(count - 1)
            count = 0
    return out


def _scan_revisit(seq, cat):
    idx = [i for i, x in enumerate(seq) if x == cat]
    return [b - a - 1 for a, b in zip(idx, idx[1:]) if b - a > 1]


def test_random_against_scan(spark):
    rnd = random.Random(7)
    seqs = [[rnd.randint(1, 3) for _ in range(rnd.randint(1, 12))] for _ in range(300)]
    df = _visits(spark, seqs)
    stats = {r.category: r for r in S.category_stats(df, mode="carry").collect()}
    for cat in (1, 2, 3):
        em = [e for s in seqs for e in _scan_carry(s, cat)]
        rv = [e for s in seqs for e in _scan_revisit(s, cat)]
        r = stats[cat]
        assert r.visits == sum(s.count(cat) for s in seqs)
        assert r.unique_visits == sum(1 for s in seqs if cat in s)
        assert r.refreshes == sum(em)
        assert r.unique_refreshes == sum(1 for s in seqs if _scan_carry(s, cat))
        assert r.longest_refresh == max(em, default=0)
        assert r.shortest_refresh == min(em, default=0)
        assert r.revisits == len(rv)
        assert r.unique_revisits == sum(1 for s in seqs if _scan_revisit(s, cat))
        assert r.longest_revisit == max(rv, default=0)
        assert r.shortest_revisit == min(rv, default=0)


def test_category_dimension_keeps_zero_rows(spark):
    df = _visits(spark, [[1, 1]])
    dim = spark.createDataFrame([(1,), (2,)], "category long")
    rows = {r.category: r for r in S.category_stats(df, categories=dim).collect()}
    assert rows[2].visits == 0 and rows[2].refreshes == 0
    assert rows[1].refreshes == 1


def test_skew_safe_path_equals_window_path(spark):
    rnd = random.Random(11)
    seqs = [[rnd.randint(1, 3) for _ in range(rnd.randint(1, 12))] for _ in range(200)]
    seqs.append([rnd.randint(1, 3) for _ in range(3000)])  # one hot user
    df = _visits(spark, seqs)
    a = sorted(tuple(r) for r in S.category_stats(df, mode="carry", skew_safe=True).collect())
    b = sorted(tuple(r) for r in S.category_stats(df, mode="carry", skew_safe=False).collect())
    assert a == b


def test_itemset_positions_share_simultaneous_events(spark):
    df = spark.createDataFrame([(1, 10, 1), (1, 10, 2), (1, 20, 3), (2, 5, 4)], "u long, ts long, eid long")
    for safe in (True, False):
        got = {r.eid: r.pos for r in S.with_positions(df, "u", ["ts", "eid"], itemsets=True, skew_safe=safe).collect()}
        assert got == {1: 0, 2: 0, 3: 1, 4: 0}
        got = {r.eid: r.pos for r in S.with_positions(df, "u", ["ts", "eid"], skew_safe=safe).collect()}
        assert got == {1: 0, 2: 1, 3: 2, 4: 0}
