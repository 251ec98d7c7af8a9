from corpusmill.llm.decontaminate import drop_contaminated, find_contained

from .common import docs, sample, shingles

ITEM = "the quick brown fox jumps over the lazy dog near the old river bank today"


def brute(rows, items, percent=80):
    sets = {i: shingles(t) for i, t in items}
    return {(d, i, len(s), len(s & x)) for d, t in rows for x in [shingles(t)] for i, s in sets.items() if s and 100 * len(s & x) >= percent * len(s)}


def found(df):
    return {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in df.collect()}


def test_against_brute_force(spark):
    d, b = sample(spark, sf="sf0.01"), sample(spark, "benchmark", "sf0.01")
    want = brute([tuple(r) for r in d.select("doc_id", "text").collect()], [tuple(r) for r in b.select("item_id", "text").collect()])
    assert found(find_contained(d, b)) == want and want


def test_item_inside_a_very_long_text(spark):
    filler = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, f"{filler} {ITEM.upper()} {filler}"), (2, filler), (3, None), (4, ""), (5, "two words"), (5, "two words"), (None, ITEM)]
    items = spark.createDataFrame([(7, ITEM, 1), (8, "two words", 1), (9, None, 1), (10, "", 1), (11, " ".join(f"w{i}" for i in range(500, 540)), 1), (7, ITEM, 1)], "item_id long, text string, k int")
    got = [(r["doc_id"], r["item_id"]) for r in find_contained(docs(spark, rows), items).collect()]
    assert sorted(got, key=str) == sorted([(1, 7), (1, 7), (1, 11), (2, 11), (5, 8), (5, 8), (None, 7), (None, 7)], key=str)
    kept = drop_contaminated(docs(spark, rows), items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4] and kept.columns == docs(spark, rows).columns


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    from corpusmill.llm import decontaminate

    d, b = sample(spark), sample(spark, "benchmark")
    whole = found(find_contained(d, b))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 7)
    assert found(find_contained(d, b)) == whole


def test_no_rows(spark):
    b = sample(spark, "benchmark")
    assert find_contained(docs(spark, []), b).count() == 0
    assert find_contained(docs(spark, [(1, ITEM)]), b.limit(0)).count() == 0
