"""The pipeline against a plain Python version of its exact stages."""

import re
from collections import Counter

from helpers_llm import alike, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_on_a_table(llm, tmp_path):
    import corpus_pipeline as C
    from rosterkit.llm.quality import judge_quality
    sf = "/root/testdata/sf0.01"
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    columns, out = docs.columns, []
    for k, (name, stage) in enumerate(C.STAGES):
        made = stage(llm, docs, sf)
        if k < 4:
            assert made.columns == columns and made.dtypes == docs.dtypes, name
        made.write.parquet(str(tmp_path / name))
        docs = llm.read.parquet(str(tmp_path / name))
        out.append(docs.collect())
    kept, cut, single, mixed, packed = out
    whole = {r.doc_id: r for r in llm.read.parquet(f"{sf}/documents.parquet").collect()}
    judged = {r.doc_id: r.kept for r in judge_quality(llm.read.parquet(f"{sf}/documents.parquet"), llm.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert {r.doc_id for r in kept} == {d for d, k in judged.items() if k} and all(r == whole[r.doc_id] for r in kept)
    # Lines: later matches go, the first of each kind stays.
    seen, index, want = [], {}, {}
    for r in sorted(kept, key=lambda r: r.doc_id):
        left = []
        for line in r.text.split("\n"):
            s = shingles(line.lower())
            near = {e for x in s for e in index.get(x, ())}
            if not (s and any(alike(s, seen[e]) for e in near)):
                left.append(line)
            if s:
                for x in s:
                    index.setdefault(x, []).append(len(seen))
                seen.append(s)
        if WORD.search("\n".join(left)):
            want[r.doc_id] = "\n".join(left)
    assert {r.doc_id: r.text for r in cut} == want and all(r.n_chars == len(r.text) for r in cut)
    # Joins: no two that stay are alike; who goes is linked to a smaller one that was there.
    sets = {r.doc_id: shingles(r.text) for r in cut}
    index = {}
    for d in sorted(sets):
        near = {e for x in sets[d] for e in index.get(x, ())}
        if any(alike(sets[d], sets[e]) for e in near):
            assert d not in {r.doc_id for r in single}
        for x in sets[d]:
            index.setdefault(x, []).append(d)
    assert {r.doc_id for r in single} <= set(sets)
    times = Counter(r.doc_id for r in mixed)
    assert set(times) <= {r.doc_id for r in single} and max(times.values()) <= 2
    words = lambda rows: sum(len(WORD.findall(r.text)) for r in rows)
    assert abs(words(mixed) / words(single) - 1.5) < 0.1
    pieces = Counter((r.doc_id, r.piece) for r in packed)
    assert {d for d, _ in pieces} == set(times) and all(pieces[d, 0] == n for d, n in times.items())
    held = Counter()
    for r in packed:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 2048 and len(held) <= -(-sum(held.values()) // 2048) + 3


def test_pipeline_is_registered(llm):
    import __spark_entry__ as E
    qs = E.queries()
    assert "pipeline" in qs and all(any(q.startswith(f"op{n}_") for q in qs) for n in range(1, 11))


def test_pipeline_of_awkward_rows(llm, make_docs, tmp_path):
    import corpus_pipeline as C
    from helpers_llm import AWKWARD
    sf = "/root/testdata/sf0.001"
    good = " ".join(f"Word{i} and" for i in range(60))
    for rows in ([], AWKWARD + [(70, good), (70, good), (71, good + " more"), (None, " ".join(f"other{i} is" for i in range(60)))]):
        docs = make_docs(rows)
        for k, (name, stage) in enumerate(C.STAGES):
            path = str(tmp_path / f"{len(rows)}-{name}")
            stage(llm, docs, sf).write.parquet(path)
            docs = llm.read.parquet(path)
        assert docs.count() >= (0 if not rows else 1)


def test_join_stage_drops_copies_with_null_ids(llm, make_docs):
    import corpus_pipeline as C
    words = lambda k: " ".join(f"{k}{i}" for i in range(60))
    near = lambda k: words(k) + " more"
    rows = [(1, words("a")), (None, words("a")), (None, near("a")),                                # go with document 1
            (None, words("b")), (None, near("b")), (None, words("b")),                             # no ids: one stays
            (7, words("c")), (7, words("d")), (7, near("d")),                                      # one id, two components
            (None, ""), (8, None)]
    left = [(r.doc_id, r.text) for r in C.near_duplicates(llm, make_docs(rows), "").collect()]
    assert len(left) == 6 and {(1, words("a")), (7, words("c")), (None, ""), (8, None)} <= set(left)
    assert sum(x in left for x in ((None, words("b")), (None, near("b")))) == 1
    assert sum(x in left for x in ((7, words("d")), (7, near("d")))) == 1


def test_join_stage_shuffles_texts_once(llm, make_docs, monkeypatch):
    import re
    from types import SimpleNamespace

    import corpus_pipeline as cp
    found = llm.createDataFrame([(1, "x", 1, "k"), (2, "x", 1, "k")], "doc_id long, text_md5 string, n_shingles long, component_key string")
    monkeypatch.setattr(cp, "ngram_jaccard_join", lambda *a, **b: SimpleNamespace(documents=found))
    plan = cp.near_duplicates(llm, make_docs([(1, "a"), (2, "a")]), "")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*\btext#", plan), plan
