import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers_llm import AWKWARD, SMALL, WORDS


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


# ------------------------------------------------------------------ chat

def test_chat_reads_back_every_turn(llm):
    from rosterkit.llm.chat import ChatTemplate, format_conversations, read_back
    nasty = ["", "~", "~1", "~~0", "</s>", "<s>[INST]x[/INST]", "[SEP]", "[IN[SEP]ST]", "a\nb", "\\E.*", "</", "</s", "~<s>~", "\U0001d11e"]
    rows = [(k, i, role, text) for k, role in enumerate(["user", "assistant", "</s>", "a~1\n"]) for i, text in enumerate(nasty)]
    rows += [(90, i, r, t) for i, (r, t) in enumerate([("user", "q"), ("assistant", "a"), ("assistant", None), ("user", "</s>"), (None, "x"), ("assistant", "~z")])]
    rows += [(91, 1, "user", "same"), (91, 1, "user", "same"), (91, None, "assistant", "first"), (None, 0, "user", "no id")]
    rows += [(92, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(700)]
    df = llm.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in read_back(format_conversations(df)).collect()}
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(out) == set(want)
    for c, turns in want.items():
        got = [(t.role, t.text) for t in out[c].turns]
        if c in (90, 92):
            assert got == [(r, x) for _, _, r, x in turns]
        assert Counter(got) == Counter((r, x) for _, _, r, x in turns)
        assert out[c].loss_text == "".join(x for r, x in got if r == "assistant")
    merged = out[90].formatted
    assert merged.count("[INST]") == merged.count("[/INST]") == 5 and "a[SEP]" in merged
    with pytest.raises(ValueError):
        ChatTemplate(controls=("ab", "bc"))
    empty = read_back(format_conversations(df.limit(0)))
    assert empty.collect() == []


def test_chat_query_equals_its_sql(llm):
    from rosterkit.llm.queries import ORACLES, QUERIES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SMALL}/conversations.parquet')")
    res = con.execute(ORACLES["op4_chat_formatting"])
    cols = [d[0] for d in res.description]
    got = {tuple(r) for r in QUERIES["op4_chat_formatting"](llm, SMALL).select(*cols).collect()}
    assert got == set(res.fetchall())
    said = "</s>[INST] ok [/INST]"
    own = next(dict(zip(cols, r)) for r in got if r[0] == -1)
    assert own["n_turns"] == 2 and own["loss_sha256"] == sha(said) and own["turns_sha256"] == sha(f"user\n{said}\nassistant\n{said}\n")


# ------------------------------------------------------------------ mixing

def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Share by weight; what passes a cap is shared again, until nothing does."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = goal - sum(cap * sizes[s] for s in capped)
        t = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        more = {s for s in free if t[s] > cap * sizes[s]}
        if not more:
            return {**{s: cap * sizes[s] for s in capped}, **t}
        capped |= more


def check_mix(rows, got):
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += len(WORDS.findall(r[1] or ""))
    target = plain_targets(dict(sizes)) if sum(sizes.values()) else {s: 0.0 for s in sizes}
    taken = Counter()
    for g in got:
        assert g.source_size == sizes[g.source] and abs(g.target - target[g.source]) < 1e-6 * max(1, target[g.source])
        assert 0 <= g.taken <= 2 * g.size
        taken[g.source] += g.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1
    assert sorted((g.doc_id or -1, g.size) for g in got) == sorted((r[0] or -1, len(WORDS.findall(r[1] or ""))) for r in rows)


def test_mixing_meets_targets(llm, make_docs):
    from rosterkit.llm.mixing import MixParams, mix, mixed_documents
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 90))), ["hot", "b", "c", "d", None][min(4, int(rng.integers(0, 9)) // 2 if i % 3 else 0)]) for i in range(300)]
    rows += [(7, "again and again", "b"), (7, "again and again", "b"), (None, "no id", "c"), (900, None, "b"), (901, "", "z"), (902, "y " * 20_000, "c")]
    docs = make_docs(rows).withColumn("size", F.lit("clash"))
    for params in (MixParams(block_words=16, group_rows=7), MixParams()):
        found, slots = mix(docs, params)
        got = found.collect()
        check_mix(rows, got)
        again, _ = mix(docs.repartition(5), params)
        key = lambda rs: sorted((r.doc_id or -1, r.source or "", r.size, r.taken) for r in rs)
        assert key(again.collect()) == key(got)
        passes = slots.groupBy("number", "block").count().agg(F.max("count")).first()[0]
        assert passes <= 2
    out = mixed_documents(make_docs(rows), MixParams(block_words=16))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    copies = Counter((r.doc_id, r.source, r.text) for r in out.collect())
    assert set(copies) <= {(r[0], r[2], r[1]) for r in rows} and max(v for k, v in copies.items() if k[0] != 7) <= 2


def test_mixing_of_nothing(llm, make_docs):
    from rosterkit.llm.mixing import mix
    assert mix(make_docs([]))[0].collect() == []
    assert [r.taken for r in mix(make_docs([(1, None, None), (2, "", "a")]))[0].collect()] == [0, 0]
    check_mix(AWKWARD_ROWS, mix(make_docs(AWKWARD_ROWS))[0].collect())


AWKWARD_ROWS = [(a, b, "s") for a, b in AWKWARD]


# ------------------------------------------------------------------ quality

def plain_statistics(text):
    text = text or ""
    words = WORDS.findall(text)
    wins = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if wins[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_rule_statistics(llm, make_docs):
    from rosterkit.llm import quality as Q
    texts = [t for _, t in AWKWARD] + ["a b c a b c", "a b a b a b", "a a a a", "l one\n\nl one\n l one\n|#|", "x\x0by\x0cz\r\nq", " wide space"]
    texts += [r.text for r in llm.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    rows = list(enumerate(texts))
    got = {r.doc_id: tuple(r)[1:6] for r in Q.rule_statistics(make_docs(rows).withColumn("n_words", F.lit("clash"))).collect()}
    assert got == {i: plain_statistics(t) for i, t in rows}
    assert Q._repeated_words_long([b"a", b"b", b"c", b"a", b"b", b"c"]) == Q.repeated_words([b"a", b"b", b"c", b"a", b"b", b"c"]) == (6, 3)


def test_forest_finds_junk_and_keeps_clean(llm):
    from rosterkit.llm import quality as Q
    sf = "/root/testdata/sf0.1"
    docs, labels = llm.read.parquet(f"{sf}/documents.parquet"), llm.read.parquet(f"{sf}/labels.parquet")
    judged = Q.judge_quality(docs, labels).join(labels, "doc_id")
    rate = {r.quality: r.k for r in judged.where("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rate[1] > 0.98 and rate[0] < 0.02
    forest = Q.fit_forest(docs, labels)
    same = Q.fit_forest(docs.repartition(7), labels.repartition(3))
    assert forest.threshold == same.threshold and (forest.split == same.split).all()


def test_quality_edge_cases(llm, make_docs):
    from rosterkit.llm import quality as Q
    labels = llm.createDataFrame([(1, 1), (4, 0), (4, None), (None, 1)], "doc_id long, quality int")
    docs = make_docs(AWKWARD)
    got = Q.judge_quality(docs, labels).collect()
    assert len(got) == len(AWKWARD) and all(g.base_failed and not g.kept for g in got)
    assert Q.judge_quality(docs.limit(0), labels).collect() == []
    long = make_docs([(1, " ".join(f"w{i}" for i in range(60))), (1, " ".join(f"w{i}" for i in range(60)))])
    assert [g.kept for g in Q.judge_quality(long, labels.limit(0)).collect()] == [True, True]
    assert Q.kept_documents(long, labels.limit(0)).count() == 2


def plain_anomaly(forest, row):
    """The mean path of one row, walked node by node."""
    total = 0.0
    for f, s, length in zip(forest.feature, forest.split, forest.length):
        k = 0
        while f[k] >= 0:
            k = 2 * k + (2 if row[f[k]] >= s[k] else 1)
        total += length[k]
    n = forest.rows
    usual = 2 * (sum(1 / i for i in range(1, n))) - 2 * (n - 1) / n                      # harmonic numbers, not their logarithm
    return 2.0 ** (-total / len(forest.feature) / usual)


def test_forest_paths_and_verdicts_equal_brute_force(llm):
    import numpy as np
    from rosterkit.llm import quality as Q
    sf = "/root/testdata/sf0.01"
    docs, labels = llm.read.parquet(f"{sf}/documents.parquet"), llm.read.parquet(f"{sf}/labels.parquet")
    forest = Q.fit_forest(docs, labels)
    stats = Q.rule_statistics(docs).toPandas()
    x = Q.features(stats)
    want = np.array([plain_anomaly(forest, r) for r in x])
    assert np.allclose(forest.scores(x), want, rtol=2e-2)
    exact = forest.scores(x)
    judged = {r.doc_id: (r.kept, r.base_failed) for r in Q.judge_quality(docs, labels).collect()}
    for d, n, again, score in zip(stats["doc_id"], stats["n_words"], stats["n_repeat_words"], exact):
        failed = bool(n < 50 or 100 * again > 50 * n)
        assert judged[d] == (not failed and bool(score < forest.threshold), failed)


def test_one_labelled_id_repeated_counts_once(llm, make_docs):
    from rosterkit.llm import quality as Q
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(55 + i))) for i in range(12)]
    labels = llm.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    once, often = Q.fit_forest(make_docs(texts), labels), Q.fit_forest(make_docs(texts + [texts[3]] * 40), labels)
    assert once.threshold == often.threshold and (once.split == often.split).all()
    assert Q.fit_forest(make_docs(texts[:3]), labels) is None                              # under four rows there is no forest
