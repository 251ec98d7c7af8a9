import pytest

from corpusmill.llm.spans import dedup_spans

from .common import docs, sample

P = "This passage of many words stands in two texts. It goes on for a while here. Then it ends with some more words."


def run(spark, rows, **kw):
    return {r["doc_id"]: r for r in dedup_spans(docs(spark, rows), **kw).collect()}


def test_first_keeps_and_later_lose(spark):
    got = run(spark, [(5, f"Own begin of five words. {P} Own end."), (2, f"Another one starts so {P}"), (9, "Nothing shared here at all, really nothing to be found.")])
    assert got[2]["text"].endswith(P) and got[2]["n_removed"] == 0
    assert got[5]["text"] == "Own begin of five words. " + P[: P.index("It goes")] + "Own end."
    assert got[9]["n_removed"] == 0 and got[5]["removed_spans"][0]["start"] > 0


def test_exact_copy_and_own_repeat(spark):
    got = run(spark, [(1, P), (2, P), (3, P), (4, "Alpha beta gamma delta epsilon zeta. Eta theta iota kappa lambda mu. " * 3)])
    assert [got[i]["text"] for i in (1, 2, 3)] == [P, "", ""]
    assert got[4]["n_sentences"] == 6 and got[4]["n_removed"] == 4


def test_long_sentence_alone(spark):
    long = " ".join(f"w{i}" for i in range(45)) + "."
    got = run(spark, [(1, f"A. {long} B."), (2, f"C. {long} D.")])
    assert got[2]["text"] == "C. D." and got[1]["n_removed"] == 0


def test_odd_rows(spark):
    got = dedup_spans(docs(spark, [(None, P), (1, None), (2, ""), (3, "One."), (4, "One."), (7, P), (7, P)])).collect()
    by = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["n_removed"]) for r in got))
    assert [x[3] for x in by] == [0] * 7 and len(by) == 7
    assert dedup_spans(docs(spark, [])).count() == 0


def brute(rows, sentences=2, min_words=12, long_words=40):
    import re

    parsed, first = {}, {}
    for d, t in rows:
        out, cur, low = [], [], t.translate({c: c + 32 for c in range(65, 91)})
        for m in re.finditer(r"[^\x20\x09-\x0D]+", low):
            gap = re.match(r"[\x20\x09-\x0D]*", low[m.end() :])[0]
            cur.append(m[0])
            if m[0][-1] in ".!?" or "\n" in gap:
                out.append(tuple(cur))
                cur = []
        parsed[d] = out + ([tuple(cur)] if cur else [])
    spans = {}
    for d, s in parsed.items():
        found = set()
        good = lambda x: (len(x) >= sentences and sum(map(len, x)) >= min_words) or sum(map(len, x)) >= long_words
        for i in range(len(s)):
            for step in (1, -1):
                j = i
                while 0 <= j < len(s):
                    a, b = min(i, j), max(i, j)
                    if good(s[a : b + 1]):
                        found.add((a, b))
                        break
                    j += step
        spans[d] = {(a, b): tuple(w for x in s[a : b + 1] for w in x) for a, b in found}
        for (a, _), key in spans[d].items():
            first[key] = min(first.get(key, (d, a)), (d, a))
    return {d: {i for (a, b), key in spans[d].items() if first[key] != (d, a) for i in range(a, b + 1)} for d in parsed}


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_against_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in sample(spark, sf=sf).collect()]
    want = brute(rows)
    got = {r["doc_id"]: r["n_removed"] for r in dedup_spans(sample(spark, sf=sf)).collect()}
    assert got == {d: len(x) for d, x in want.items()} and sum(got.values()) > 0


def run_sentences(text, least=8, clause=16):
    import re

    low = text.translate({c: c + 32 for c in range(65, 91)})
    words = [(m[0], re.match(r"[\x20\x09-\x0D]*", low[m.end() :])[0]) for m in re.finditer(r"[^\x20\x09-\x0D]+", low)]
    out, cur = [], []
    for w, gap in words:
        cur.append(w)
        if w[-1] in ".!?" or "\n" in gap:
            out.append(cur)
            cur = []
    out += [cur] if cur else []
    cut = []
    for s in out:
        cut.append([])
        for i, w in enumerate(s):
            cut[-1].append(w)
            if len(s) > clause and w[-1] in ",;:" and i + 1 < len(s):
                cut.append([])
    joined = []
    for s in cut:
        if joined and len(joined[-1]) < least:
            joined[-1] = joined[-1] + s
        else:
            joined.append(s)
    return [tuple(s) for s in joined]


def brute_runs(rows, k=2):
    """(key, text) -> removed sentences of each of its rows, for every run of k sentences."""
    import xxhash

    def place(row):
        key, text = row
        mark = xxhash.xxh64_intdigest(text.encode(), seed=42)
        mark ^= 0x5851F42D4C957F2D if key is None else 0
        return (key is None, key or 0, mark - (1 << 64) if mark >> 63 else mark)

    seen, out = set(), {}
    for key, text in sorted((r for r in rows if r[1] is not None), key=place):
        s = run_sentences(text)
        spans = [(i, i + k) for i in range(len(s) - k + 1)] or ([(0, len(s))] if s else [])
        gone, own = set(), set()
        if out.get((key, text)):
            gone = set(range(len(s)))
        for a, b in spans:
            words = tuple(w for x in s[a:b] for w in x)
            if words in seen or words in own:
                gone |= set(range(a, b))
            own.add(words)
        seen |= own
        out.setdefault((key, text), []).append(len(gone))
    return out


def check_runs(spark, rows):
    from corpusmill.llm.spans import dedup_runs

    got = sorted(((r["doc_id"], r["n_removed"]) for r in dedup_runs(docs(spark, rows)).collect()), key=str)
    want = [(key, n) for (key, _), each in brute_runs(rows).items() for n in each] + [(k, 0) for k, t in rows if t is None]
    assert got == sorted(want, key=str)
    return sum(n for _, n in got)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_runs_against_brute_force(spark, sf):
    assert check_runs(spark, [(r["doc_id"], r["text"]) for r in sample(spark, sf=sf).collect()]) > 0


def test_runs_of_repeated_and_odd_rows(spark, monkeypatch):
    from corpusmill.llm import spans

    long = " ".join(f"Sentence number {i} of a text that has very many of them." for i in range(20_000))
    short = "One two three four. Five six seven eight."
    rows = [(7, P), (7, P), (7, P), (None, P), (None, P), (None, short), (8, short), (9, "x" + long), (9, long), (3, None), (3, None), (None, None), (1, ""), (1, ""), (2, " \n "), (4, "One."), (5, "One."), (6, "Alone here.")]
    assert check_runs(spark, rows) > 0
    monkeypatch.setattr(spans, "COPIES", 1)
    check_runs(spark, rows)
    check_runs(spark, [(1, P), (2, P), (None, short)])
    check_runs(spark, [(1, P), (1, short + " " + P), (None, short)])
    left = {r["doc_id"]: r["text"] for r in spans.dedup_runs(docs(spark, [(1, P), (2, f"Some words of its own stand here first. {P}"), (3, short), (4, short)])).collect()}
    assert left[1] == P and "It goes on" not in left[2] and left[2].startswith("Some words") and (left[3], left[4]) == (short, "")
    assert spans.dedup_runs(docs(spark, [])).count() == 0


def test_a_single_long_sentence_is_no_run(spark):
    from corpusmill.llm.spans import dedup_runs

    long = " ".join(f"w{i}" for i in range(45)) + "."
    rows = [(1, f"Eight words stand here before all the others. {long} And eight words stand here behind all others."), (2, f"Other words stand here before all the others. {long} Then other words stand here behind all others.")]
    assert [r["n_removed"] for r in dedup_runs(docs(spark, rows)).collect()] == [0, 0]
