import random

from cartloom.llm import neardup

from . import cases


def brute(rows, percent=80):
    sets = [cases.shingles(t, 2) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(
        ((d, len(sets[i]), least[find(i)] if d is not None else None, d is None or least[find(i)] == d) for i, (d, _) in enumerate(rows)), key=str
    )


def found(frame, settings=neardup.Settings()):
    return sorted((tuple(r) for r in neardup.near_duplicates(frame, settings).collect()), key=str)


def test_odd_documents(spark):
    frame = cases.odd_documents(spark)
    assert found(frame) == brute([(r["doc_id"], r["text"]) for r in frame.collect()])
    assert neardup.near_duplicates(cases.empty_documents(spark)).count() == 0
    kept = {r["doc_id"] for r in neardup.without_copies(frame).collect()}
    assert kept == {None, 1, 2, 3, 4, 6, 9, 12}


def test_groups_of_near_copies_with_many_rounds(spark):
    draw = random.Random(2)
    rows, number = [], 0
    for group in range(3):
        core = [f"g{group}w{i}" for i in range(120)]
        for _ in range(60):
            text = list(core)
            for _ in range(draw.randint(0, 9)):
                text[draw.randrange(len(text))] = f"r{draw.randrange(10**6)}"
            rows.append((number, " ".join(text)))
            number += 1
    rows += [(number + i, cases.words(i, draw.randint(1, 5))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    wanted = brute(rows)
    assert found(frame) == wanted
    assert found(frame, neardup.Settings(pairs_per_class=0.01, few=4, block=16)) == wanted
    assert found(frame, neardup.Settings(pairs_per_class=1e9, few=4, block=32, block_shingles=3000)) == wanted


def test_components_of_a_chain(spark):
    pairs = [(i + 1, i) for i in range(40)] + [(100, 101), (101, 102), (7, 7)]
    rows = neardup.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert {r["id"]: r["component"] for r in rows} == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}


def test_components_of_random_links(spark):
    draw = random.Random(5)
    for many in (12, 40, 70):
        pairs = [(draw.randrange(60), draw.randrange(60)) for _ in range(many)]
        parent = list(range(60))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in pairs:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
        linked = {i for a, b in pairs if a != b for i in (a, b)}
        rows = neardup.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
        assert {r["id"]: r["component"] for r in rows} == {i: find(i) for i in linked if find(i) != i}


def test_stars_are_planned_small_and_once(spark, monkeypatch):
    def leaves(frame):
        return frame._jdf.queryExecution().optimizedPlan().collectLeaves().size()

    written = []
    real = neardup.stage
    monkeypatch.setattr(neardup, "stage", lambda df, name: written.append(leaves(df)) or real(df, name))
    # Links that lead to the smallest id already need no step, others none beyond the one that settles them.
    neardup.components(spark.createDataFrame([(1, 2), (3, 1), (9, 8)], "a bigint, b bigint"))
    assert len(written) == 1
    neardup.components(spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a bigint, b bigint"))
    assert len(written) >= 3 and max(written) <= 4
    members = spark.createDataFrame([(b, i, i) for b in range(3) for i in range(20)], "bucket bigint, id bigint, component bigint")
    assert leaves(neardup._hub_pairs(members, 0, neardup.Settings())) == 2
