import datetime as dt
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers_llm import AWKWARD, SMALL, alike, shingles


def components(rows):
    """(smallest linked id, set size) per row, by brute force."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))
    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                top[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        ids[r] = min((x for x in (ids.get(r), d) if x is not None), default=None)
    return [(ids[find(i)], len(sets[i])) for i in range(len(rows))]


def family(rng, n, size, edits):
    base = [f"w{rng.integers(0, 900)}" for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(int(rng.integers(0, edits + 1))):
            words[int(rng.integers(0, size))] = f"e{rng.integers(0, 10**6)}"
        out.append(" ".join(words[: size - int(rng.integers(0, 4))]))
    return out


def test_ngram_join_equals_brute_force(llm, make_docs):
    from rosterkit.llm.ngram_join import JoinParams, ngram_jaccard_join
    rng = np.random.default_rng(5)
    texts = [x for k in range(8) for x in family(rng, 9, 40 + 10 * k, 2 + k % 4)] + family(rng, 40, 60, 5)
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [passage + " " + " ".join(f"u{i}_{j}" for j in range(40)) for i in range(12)]        # share a passage, not alike
    # a link at exactly 80 %: eight shared shingles of ten
    texts += [" ".join(f"x{i}" for i in range(13)), " ".join([*(f"x{i}" for i in range(12)), "y"])]
    rows = [(1000 + i, t) for i, t in enumerate(rng.permutation(texts).tolist())]
    rows += [r for r in AWKWARD if r[0] != 5] + [(5, "one")]
    rows += [(1000, rows[0][1])]                                                                   # a repeated row
    for params in (JoinParams(), JoinParams(sketch_bits=8), JoinParams(list_rows=2)):
        res = ngram_jaccard_join(make_docs(rows).withColumn("n", F.lit("clash")), params)
        got = sorted(((r.doc_id, r.component_id, r.n_shingles) for r in res.documents.collect()), key=repr)
        want = sorted(((d, c, n) for (d, _), (c, n) in zip(rows, components(rows))), key=repr)
        assert got == want
        for link in res.links.collect():
            assert 100 * link.both >= 80 * link.either
    assert ngram_jaccard_join(make_docs([])).documents.collect() == []


def test_ngram_join_of_null_and_repeated_ids(llm, make_docs):
    """Null ids link like any others, and a repeated id keeps all of its texts."""
    from rosterkit.llm.ngram_join import ngram_jaccard_join
    rng = np.random.default_rng(15)
    texts = [family(rng, 6, 60, 2) for _ in range(4)]
    rows = [(None if i < 4 else 100 + i, t) for i, t in enumerate(texts[0])]                       # a null id near others
    rows += [(None, t) for t in texts[1]] + [(None, texts[1][0])]                                  # a family of null ids only
    rows += [(200 + i % 2, t) for i, t in enumerate(texts[2] + texts[3])]                          # two ids, two families
    res = ngram_jaccard_join(make_docs(rows)).documents.collect()
    got = sorted(((r.doc_id, r.component_id, r.n_shingles) for r in res), key=repr)
    assert got == sorted(((d, c, n) for (d, _), (c, n) in zip(rows, components(rows))), key=repr)
    digests = {hashlib.md5(t.encode()).hexdigest(): t for _, t in rows}
    keys = {}
    for r in res:
        keys.setdefault(r.component_key, set()).add(digests[r.text_md5])
    want, sets = {t: {t} for _, t in rows}, {t: shingles(t) for _, t in rows}
    for x in want:
        for y in want:
            if alike(sets[x], sets[y]) and want[x] is not want[y]:
                want[x] |= want[y]
                for z in want[x]:
                    want[z] = want[x]
    assert sorted(map(sorted, keys.values())) == sorted(map(sorted, {id(v): v for v in want.values()}.values()))


def test_ngram_join_lists_all_links(llm, make_docs, monkeypatch):
    """Links between all different texts, and their number per document, also where blocks are many."""
    from rosterkit.llm import ngram_join as N
    rng = np.random.default_rng(25)
    texts = family(rng, 30, 60, 3) + family(rng, 12, 90, 9) + family(rng, 2, 50, 1) + family(rng, 3, 70, 1)
    base = [f"c{i}" for i in range(200)]
    texts += [" ".join(base[:200 - 9 * i]) for i in range(15)]                                     # a chain over several sizes
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts + texts[:5])] + [(900, None), (901, "")]
    sets = {t: shingles(t) for _, t in rows if t}
    distinct = {s: min(t for t in sets if sets[t] == s) for s in sets.values() if s}
    want = {frozenset((distinct[x], distinct[y])): (len(x & y), len(x | y)) for x in distinct for y in distinct if x != y and alike(x, y)}
    degrees = sorted(sum(alike(shingles(t), shingles(u)) for j, (_, u) in enumerate(rows) if j != i) for i, (_, t) in enumerate(rows))
    for size in (1024, 4):
        monkeypatch.setattr(N, "_BLOCK_SETS", size)
        res = N.ngram_jaccard_join(make_docs(rows))
        text = {hashlib.md5(t.encode()).hexdigest(): distinct[sets[t]] for t in sets if sets[t]}
        name = {r.cls: text[r.md5] for r in res.classes.collect()}
        got = [(frozenset((name[r.a], name[r.b])), (r.both, r.either)) for r in res.links.collect()]
        assert len(got) == len(want) and dict(got) == want
        assert sorted(r.n_links for r in res.documents.collect()) == degrees
    for params in (N.JoinParams(), N.JoinParams(list_rows=1)):
        assert sorted(r.n_links for r in N.ngram_jaccard_join(make_docs(rows), params, links="counts").documents.collect()) == degrees


def test_line_dedup_equals_brute_force(llm, make_docs):
    from rosterkit.llm.line_dedup import dedup_lines
    rng = np.random.default_rng(6)
    lines = [x for k in range(6) for x in family(rng, 6, 12 + 8 * k, 1 + k % 3)] + ["short", "Short", "a b c", "", "  ", "\ttab line here now ok", "tab  line here now ok"]
    rows = [(i, "\n".join(rng.choice(lines, 6))) for i in range(40)] + [r for r in AWKWARD if r[0] is None or r[0] > 90] + [(900, None), (901, "")]
    rows += [(3, rows[3][1])]
    got = {}
    for r in dedup_lines(make_docs(rows).withColumn("place", F.lit("clash"))).collect():
        assert r.place == "clash"
        got.setdefault((r.doc_id, r.text is None), []).append((r.removed_lines, r.text))
    seen, want = [], {}
    for d, t in sorted(dict.fromkeys(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        gone = []
        for i, line in enumerate((t or "").split("\n") if t is not None else []):
            s = shingles(line)
            if s and any(alike(s, e) for e in seen):
                gone.append(i)
            if s:
                seen.append(s)
        want[d, t is None] = (gone, None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone))
    assert {k: v[0] for k, v in got.items()} == want
    assert len(got[3, False]) == 2 and got[3, False][0] == got[3, False][1]
    assert dedup_lines(make_docs([])).collect() == []


def test_line_tokens_are_counted_without_arrays(llm, make_docs):
    """The rarity table counts the very tokens that the sets hold, hashed a
    row at a time: one lambda (the words) instead of two and no sets."""
    from collections import Counter

    from rosterkit.llm.line_dedup import LineParams, _bucket_counts, _lines, _tokens
    texts = ["a b c d e f g\nA\n\n \t \x0b\na  b\tc\r", "one two three four\none two three four five\n\x0c", None, "", "x y z x1 y1 z1 a b c d e f g\n\u00e4 \u00a0 \u4e2d"]
    params = LineParams()
    lines = _lines(make_docs(list(enumerate(texts))), "doc_id", "text")
    sets = [r.t for r in _tokens(lines, params.words).collect()]
    assert sorted(map(len, sets)) == [1, 1, 1, 1, 1, 3, 9] and len({t for s in sets for t in s}) == 14
    counts = _bucket_counts(lines, params)
    assert {r.b: r.n for r in counts.collect()} == Counter(t % params.buckets for s in sets for t in s)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" not in plan and plan.count("lambdafunction(") == 1


@pytest.mark.parametrize("size", [1.0, 2.0 ** 26, 2.0 ** 31, 1e30])
def test_top_k_equals_brute_force(llm, size):
    from rosterkit.llm.topk import SearchParams, top_k
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (size if i % 2 else 1)]) for i in range(300)]
    rows += [(400 + i, [0.25, 0.5, 0.0, 0.0, 0.0, -0.1]) for i in range(60)]                 # ties
    rows += [(None, rows[20][1]), (None, [1.0] * 6), (20, rows[21][1]), (20, rows[20][1]), rows[0], (2 ** 60 + 1, rows[40][1]), (2 ** 60 + 3, rows[40][1])]
    rows += [(2000, [1.0, 2.0]), (2001, [3.0, -1.0]), (2002, [1.0, 1.0]), (2020, []), (2021, []), (2040, [0.0] * 6)]
    bad = [(1000, None), (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1003, [float("nan")] * 6), (1020, [float("inf")] * 6)]
    df = llm.createDataFrame(rows + bad, "vec_id long, embedding array<double>").repartition(3).withColumn("score", F.lit("clash"))
    ints = [(i, [int(x) * 64 if abs(x) >= 2 ** 53 else int(np.floor(64 * x)) for x in v]) for i, v in rows]
    cut, want = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s)), []
    for n, (q, u) in enumerate(ints):
        if q is not None and q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(u, v)), i is None, i or 0) for m, (i, v) in enumerate(ints) if m != n and len(v) == len(u))[:5]
            want += [(q, r, None if none else i, cut(-s)) for r, (s, none, i) in enumerate(best, 1)]
    for params in (SearchParams(k=5), SearchParams(k=5, shard_values=350, block_values=49, leaf_rows=8, chain=3)):
        assert sorted(map(repr, ((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(df, params).collect()))) == sorted(map(repr, want))
    assert top_k(df.limit(0)).collect() == []


def test_balls_hold_their_rows():
    from rosterkit.llm.topk import BallTree
    x = np.floor(64 * np.random.default_rng(3).normal(size=(500, 7)))
    x[100:260] = x[100]
    tree, order = BallTree.build(x, 16)
    assert sorted(order.tolist()) == list(range(500)) and (tree.lo[0], tree.hi[0]) == (0, 500)
    x = x[order]
    for i, kid in enumerate(tree.kids):
        far = np.linalg.norm(x[tree.lo[i]:tree.hi[i]] - tree.centre[i], axis=1).max()
        assert far <= tree.radius[i] + 1e-9
        if kid:
            assert (tree.lo[i], tree.hi[kid], tree.hi[i]) == (tree.lo[kid], tree.lo[kid + 1], tree.hi[kid + 1])
        else:
            assert tree.hi[i] - tree.lo[i] <= 16 or tree.radius[i] == 0


def test_few_nodes_are_entered_where_vectors_cluster():
    from rosterkit.llm import topk as T
    from rosterkit.llm.vectors import Rows
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8)) * 5
    x = centres[np.arange(4000) % 40] + rng.normal(size=(4000, 8)) * 0.05
    tree, order = T.BallTree.build(np.floor(64 * x), 32)
    rows = Rows(order, order, np.ones(4000, bool), [None] * 4000, x[order])
    one = Rows(np.array([7]), np.array([7]), np.array([True]), [None], x[7:8])
    seen, whole = [], T.scores
    T.scores = lambda q, y: seen.append(len(y)) or whole(q, y)
    try:
        T.search(tree, rows, one, np.array([-(2 ** 62)]), 5, 64, 10 ** 9)
    finally:
        T.scores = whole
    assert sum(seen) < 800


def test_top_k_query_equals_its_sql(llm):
    import duckdb
    from rosterkit.llm.queries import ORACLES, QUERIES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SMALL}/embeddings.parquet')")
    got = {tuple(r) for r in QUERIES["op6_exact_topk"](llm, SMALL).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == set(con.execute(ORACLES["op6_exact_topk"]).fetchall())


# ------------------------------------------------------------------ pseudonyms

def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_feistel_is_a_permutation():
    from rosterkit.llm.pseudonyms import Feistel
    f = Feistel(b"key")
    for n in (1, 2, 3, 10, 97, 1000):
        image = [f.encrypt("k", n, i) for i in range(n)]
        assert sorted(image) == list(range(n)) and [f.decrypt("k", n, y) for y in image] == list(range(n))
    for n in (10 ** 15, 16 ** 40, 898 * 99 * 9999):
        assert all(f.decrypt("k", n, f.encrypt("k", n, x)) == x and 0 <= f.encrypt("k", n, x) < n for x in (0, 1, n // 3, n - 1))
    assert [Feistel(b"other").encrypt("k", 10 ** 9, i) for i in range(5)] != [f.encrypt("k", 10 ** 9, i) for i in range(5)]


def test_pseudonyms_keep_format_and_links(llm, make_docs):
    from rosterkit.llm.pseudonyms import PseudonymParams, iban_digits, pseudonymize
    text = ("IBAN DE89 3704 0044 0532 0130 00, 078-05-1120 on 2024-02-29 or 12/31/1999 or 29.02.2024, (212) 555-1234, +1 (017) 555-7713, "
            "4111-1111-1111-1111, ip 8.8.4.4, mail jo.98@mail5.example.com, token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"")
    clean = ("2024-02-30 31.04.2024 13/13/2024 000-12-3456 4111111111111112 999.1.1.1 version 3.2.1 in 1999, 12345, a@b, DE89 3704 0044 0532 0130 02, "
             "Licensed under CC BY-NC 4.0. 0000000000000000")
    rows = AWKWARD + [(50, text), (51, "again 4111 1111 1111 1111 and jo.98@mail5.example.com"), (52, clean)]
    out = {r.doc_id: r for r in pseudonymize(make_docs(rows).withColumn("finds", F.lit(1))).collect()}
    assert all(out[d].text == t and out[d].n_finds == 0 for d, t in AWKWARD if d is not None) and out[52].text == clean
    new, finds = out[50].text, out[50].finds
    assert len(new) == len(text) and [f.kind for f in finds] == ["iban", "ssn", "date", "date", "date", "phone", "phone", "card", "ip", "mail", "secret"]
    part = {}
    for f in finds:
        old, now = text[f.start:f.start + f.length], new[f.start:f.start + f.length]
        assert old != now and re.sub(r"[0-9A-Za-z]", "x", old) == re.sub(r"[0-9A-Za-z]", "x", now)
        part.setdefault(f.kind, []).append(now)
    assert luhn(re.sub(r"\D", "", part["card"][0]))
    code = part["iban"][0].replace(" ", "")
    assert iban_digits(code[:2], code[4:]) == code[2:4]
    day = dt.date.fromisoformat(part["date"][0])
    assert part["date"][2] == day.strftime("%d.%m.%Y")                                   # one day, two formats
    again = out[51].text
    assert re.sub(r"\D", "", part["card"][0]) in re.sub(r"[ ]", "", again) and part["mail"][0] in again
    back = pseudonymize(make_docs([(r.doc_id, r.text) for r in out.values() if r.doc_id in (50, 51)]), PseudonymParams(inverse=True)).collect()
    assert {r.doc_id: r.text for r in back} == {50: text, 51: rows[-2][1]}
    assert pseudonymize(make_docs([])).collect() == []


def test_pseudonyms_of_other_shapes():
    """Shapes that the tables do not hold; each is found whole and turned back."""
    from rosterkit.llm.pseudonyms import Feistel, pseudonymize_text
    shapes = [("card", "4111 1111 1111 1111", "pay ", " 12/25"), ("card", "4111 1111 1111 1111", "", " 1111 123"), ("card", "4111-1111-1111-1111", "", "-99 x"),
              ("card", "378282246310005", "no 17 ", " 2025"), ("iban", "BE68 5390 0754 7034", "", " BIC KREDBEBB"), ("iban", "NO9386011117947", "", " OK"),
              ("iban", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "", " END"),
              ("phone", "+44 20 7946 0958", "call ", "."), ("phone", "+33 6 12 34 56 78", "", ""), ("phone", "+49 30 12345678", "", ""),
              ("phone", "555-123-4567", "", ", or"), ("phone", "0044 20 7946 0958", "", ""), ("phone", "(020) 7946 0958", "", ""), ("phone", "1-800-555-1234", "", ""),
              ("secret", "password=hunter2secret", "", " x"), ("secret", "secret = \"aB3/x+9kQ==\"", "client_", ""), ("secret", "secret_access_key=wJalrXUtnFEMI/K7MDENG+bPxRfi", "aws_", "\n"),
              ("secret", "password\": \"" + "k3y" * 200 + "\"", "{\"", "}"), ("secret", "Token: 9f8e7d6c5b", "", ""), ("secret", "pwd='pä55wörter'", "", ""),
              ("date", "31/12/1999", "on ", ""), ("date", "1/2/2024", "", ""), ("date", "2024/2/9", "", ""), ("date", "13-1-2024", "", ""), ("date", "3.2.1999", "", ""),
              ("date", "2024-02-29", "", "T10:15:00Z")]
    wrong = []
    for key in (b"one", b"two", b"three", b"four"):
        cipher = Feistel(key)
        for kind, value, before, after in shapes:
            text = before + value + after
            new, finds = pseudonymize_text(text, cipher.encrypt)
            if finds != [(kind, len(before), len(value))] or new == text or pseudonymize_text(new, cipher.decrypt, True) != (text, finds):
                wrong.append((text, new, finds))
    assert not wrong
    said = {pseudonymize_text(x, cipher.encrypt)[0] for x in ("2024-03-05", "2024/3/5")}
    assert len({tuple(int(n) for n in re.split("[-/]", x)) for x in said}) == 1                  # one day, however it is written
    for text in ("tokenizer = \"bpe_50k_large\"", "password: please ask", "secret = function(abc)", "12 345 678 901 234 567 890 12", "1.2.3.4.5", "the token is long"):
        assert pseudonymize_text(text, cipher.encrypt) == (text, []), text


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_pseudonyms_on_the_table(llm, sf):
    """Whatever a plain scan finds valid is gone; lengths and the rest stay."""
    from rosterkit.llm.pseudonyms import pseudonymize
    docs = llm.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    old = {r.doc_id: r.text for r in docs.collect()}
    for r in pseudonymize(docs).collect():
        t = old[r.doc_id]
        mask = bytearray(len(t))
        for f in r.finds:
            mask[f.start:f.start + f.length] = b"\1" * f.length
        assert len(t) == len(r.text) and all(a == b for a, b, m in zip(t, r.text, mask) if not m)
        for m in re.finditer(r"[\w.]+@[\w.]+\w|(?<![\d.])\d{16}(?!\d)", t):
            if "@" in m[0] or luhn(m[0]):
                assert m[0] not in r.text


def test_many_cards_in_one_run():
    import random
    import time
    from rosterkit.llm import pseudonyms as P
    rng, key = random.Random(5), P.Feistel(b"k")

    def card():
        d = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(14))
        d += P.luhn_digit(d)
        return rng.choice([d, " ".join(d[i:i + 4] for i in range(0, 16, 4)), "-".join(d[i:i + 4] for i in range(0, 16, 4))])

    for _ in range(300):                                                   # cards beside numbers that are none, some equal
        t = " ".join(rng.choice([card(), str(rng.randint(0, 10 ** rng.randint(1, 19))), "4111 1111 1111 1111"]) for _ in range(rng.randint(1, 8)))
        out, _ = P.pseudonymize_text(t, key.encrypt)
        assert P.pseudonymize_text(out, key.decrypt, True)[0] == t and len(out) == len(t)
    t, start = " ".join(card() for _ in range(20_000)), time.process_time()
    out, finds = P.pseudonymize_text(t, key.encrypt)
    assert time.process_time() - start < 30 and len(finds) == 20_000 and out != t
    assert P.pseudonymize_text(out, key.decrypt, True)[0] == t


IDS = [(2 ** 60 + 1, "a b c d e f g h i j k"), (None, "a b c d e f g h i j z"), (2 ** 60 + 3, "a b c d e f g h i j k l"), (2 ** 60 + 5, "pay 4111 1111 1111 1111")]


def test_large_ids_beside_a_null_stay_exact(make_docs):
    from rosterkit.llm.best_two_fit import best_two_fit
    from rosterkit.llm.ngram_join import JoinParams, ngram_jaccard_join
    from rosterkit.llm.pseudonyms import pseudonymize
    from rosterkit.llm.quality import judge_quality, rule_statistics
    from rosterkit.llm.token_output import packed_sequences
    from rosterkit.llm.unigram import count_tokens
    docs, key = make_docs(IDS).coalesce(1), lambda x: (x is None, x or 0)
    want = sorted((d for d, _ in IDS), key=key)
    ids = lambda df: sorted((r.doc_id for r in df.collect()), key=key)
    assert ids(best_two_fit(docs)) == ids(count_tokens(docs)) == ids(pseudonymize(docs)) == ids(rule_statistics(docs)) == want
    assert sorted((d for r in packed_sequences(docs).collect() for d in r.doc_ids), key=key) == want
    labels = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    assert ids(judge_quality(docs, labels)) == want
    got = {r.doc_id: (r.component_id, r.n_links) for r in ngram_jaccard_join(docs, JoinParams(percent=70)).documents.collect()}
    assert got == {2 ** 60 + 1: (2 ** 60 + 1, 2), None: (2 ** 60 + 1, 1), 2 ** 60 + 3: (2 ** 60 + 1, 1), 2 ** 60 + 5: (2 ** 60 + 5, 0)}


def test_join_shuffles_only_texts_of_classes(make_docs):
    from rosterkit.llm.ngram_join import _near_places, _of_classes
    rows = [(i, f"text {i}") for i in range(300)] + [(None, "text"), (None, None), (7, "text 7"), (7, "other")]
    docs = make_docs(rows).select("doc_id", "text").withColumn("text_md5", F.md5("text"))
    spark = docs.sparkSession
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    classes = spark.createDataFrame([(1, 7, md5("text 7")), (2, None, md5("text"))], "cls long, rep long, md5 string")
    near = _near_places(docs, classes, 25)
    assert sorted(((r.doc_id, r.text) for r in near.collect()), key=repr) == [(7, "text 7"), (7, "text 7"), (None, "text")]
    full = spark.createDataFrame([(i, i, md5(f"text {i}")) for i in range(300)], classes.schema)
    assert _near_places(docs, full, 6).count() >= 301                                             # a full filter loses nothing
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = _of_classes(near, classes)
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        assert sorted((r.cls, r.text) for r in found.collect()) == [(1, "text 7"), (2, "text")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_shingle_hashes_tell_shingles_apart():
    from rosterkit.llm.ngram_join import shingle_hashes, shingle_sets
    rng = np.random.default_rng(4)
    pool = [b"a", b"b", b"a\0", b"a" * 8, b"a" * 9, b"b" + b"a" * 8, b"a" * 64, b"a" * 65, b"a" * 64 + b"b", b"A" * 70, "é z".encode()]
    texts = [b"".join(pool[j] + [b" ", b"\t\n", b"\x0b \x0c\r"][j % 3] for j in rng.integers(0, len(pool), n)) for n in [*range(12), *range(12)]]
    texts += [None, b"", b" \n", *(b"w%d " % i * 40_000 for i in range(3))]
    seen, back = {}, {}
    for text, got, held in zip(texts, shingle_hashes(texts, 5), shingle_sets(texts, 5), strict=True):
        words = (text or b"").lower().split()
        width = min(5, len(words))
        grams = [tuple(words[i:i + width]) for i in range(len(words) - width + 1)] if words else []
        assert len(got) == len(grams) and held.tolist() == sorted(set(got.tolist()))
        for g, h in zip(grams, got.tolist()):
            assert seen.setdefault(g, h) == h and back.setdefault(h, g) == g


def test_prefix_entries_are_shuffled_once(llm):
    from rosterkit.llm.ngram_join import _token_lists
    firsts = llm.createDataFrame([(1, 10, [5, 6]), (2, 11, [6]), (3, 12, [7, 6]), (4, 13, [8])], "cls long, n long, prefix array<long>")
    lists = _token_lists(firsts)
    assert lists._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, lists.collect())) == [(6, 1, 10, 1, 1, 3), (6, 2, 11, 0, 1, 3), (6, 3, 12, 1, 1, 3)]


def test_pairs_are_verified_in_passes(llm, monkeypatch):
    from rosterkit.llm import ngram_join as J
    rng = np.random.default_rng(2)
    held = {c: np.unique(rng.integers(0, 40, 20).astype(np.uint64)) for c in range(60)}
    sets = llm.createDataFrame([(c, bytearray(s.tobytes())) for c, s in held.items()], "cls long, s binary")
    want = {(a, b): (len(np.intersect1d(held[a], held[b])), len(np.union1d(held[a], held[b]))) for a in range(60) for b in range(0, a, 7)}
    pairs = llm.createDataFrame(list(want), "a long, b long")
    names, real = [], J.materialize
    monkeypatch.setattr(J, "materialize", lambda df, name: (names.append(name), real(df, name))[1])
    for params, passes in ((J.JoinParams(pass_pairs=50, passes=3), 3), (J.JoinParams(), 1)):
        names.clear()
        got = J._verify(pairs, sets, params, "checked")
        assert {(r.a, r.b): (r.both, r.either) for r in got.collect()} == want and got.count() == len(want) and names == ["checked"] * passes
    assert J._verify(pairs.limit(0), sets, J.JoinParams(), "checked").count() == 0


def test_blocks_shuffle_only_sets_of_their_classes(llm, monkeypatch):
    from rosterkit.llm import ngram_join as J
    seen, real = [], J._may_match
    monkeypatch.setattr(J, "_may_match", lambda *a: (seen.append(real(*a)), seen[-1])[1])
    sets = llm.createDataFrame([(c, bytearray(np.arange(c % 3, 30, dtype=np.uint64).tobytes())) for c in range(200)], "cls long, s binary")
    large = llm.createDataFrame([(c, 30 - c % 3, 1, 0) for c in range(4)], "cls long, n long, copies long, component long")
    links = J._inner_links(large, sets, J.JoinParams(), "counts")
    assert {r.id: r.n for r in links.groupBy("id").agg(F.sum("n_links").alias("n")).collect()} == {c: 3 for c in range(4)}
    assert len(seen) == 1 and sorted(r.cls for r in seen[0].collect()) == [0, 1, 2, 3]
