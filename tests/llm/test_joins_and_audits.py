"""Operators 11 to 13 against brute force and their SQL, on odd rows too."""

import math
import random
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from sievework.llm import divergence, negatives, setrelation
from sievework.llm.queries import ORACLES, QUERIES
from sievework.operators import setjoin
from tests_helpers import WORD


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    words = WORD.findall(lowered(text))
    return {tuple(words[k : k + 4]) for k in range(len(words) - 3)} if len(words) >= 4 else {tuple(words)} - {()}


def brute_join(texts, p=85):
    sets = [shingles(t) for t in texts]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= p * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return [len(s) for s in sets], root


def crowds(seed=3):
    """Crowds of near copies, a crowd beside it at about the bar, chains, short texts, and texts that share a passage only."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(120)]

    def edit(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = f"x{rng.random()}"
        return " ".join(words)

    other = base[:105] + [f"v{i}" for i in range(15)]
    texts = [edit(base, rng.choice([0, 1, 1, 2])) for _ in range(40)] + [edit(other, rng.choice([0, 1, 1, 2])) for _ in range(40)]
    texts += [" ".join(f"c{k}" for k in range(i, i + 80)) for i in range(0, 60, 4)]
    texts += [" ".join(base[:60]) + " " + " ".join(f"y{rng.random()}" for _ in range(60)) for _ in range(30)]
    texts += ["a b c", "A B  c", "a b", "a b c d", "a b c d e", "", "  \n", None, None, texts[0].upper(), texts[0]]
    rng.shuffle(texts)
    return texts


def test_jaccard_join_matches_brute_force(spark):
    texts = crowds()
    sizes, root = brute_join(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setrelation.join(df).collect()}
    assert got == {i: (n, r) for i, (n, r) in enumerate(zip(sizes, root, strict=True))}


def test_answers_are_derived_from_heads(spark, monkeypatch):
    """Pairs across crowds whose heads share too little are refused by the bounds; only open ones are counted."""
    asked = {}
    keep = setrelation.Scratch.keep

    def counted(scratch, df, name):
        out = keep(scratch, df, name)
        asked[name] = out.count()
        return out

    monkeypatch.setattr(setrelation.Scratch, "keep", counted)
    monkeypatch.setattr(setrelation, "SAMPLE", 1 << 40)  # so that the order doesn't know what both crowds share
    base = [f"w{i}" for i in range(6400)]  # long enough for the sketches to say nothing
    other = base[:5600] + [f"v{i}" for i in range(800)]
    texts = [" ".join([*words, f"x{i}"]) for words in (base, other) for i in range(25)]
    sizes, root = brute_join(texts)
    got = setrelation.join(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(root)) and len(set(root)) == 2
    assert asked["related"] > 20, asked
    assert asked["open"] + asked["heads"] < asked["related"] / 4


def test_derived_bounds_decide_and_leave_open(spark):
    """Heads 1 and 2 share 90 of 100; members differ a little; what the bounds leave open is counted."""
    sizes = spark.createDataFrame([(1, 100), (2, 100), (11, 100), (12, 100), (21, 100), (22, 84)], "sid bigint, m bigint")
    heads = spark.createDataFrame([(11, 1, 99), (12, 1, 92), (21, 2, 99), (22, 2, 84)], "sid bigint, head bigint, both bigint")
    near = spark.createDataFrame([(11, 21), (11, 22), (12, 21), (12, 22)], "x bigint, y bigint")
    truth, called = {(1, 2): 95, (11, 22): 84, (12, 21): 92, (12, 22): 84}, []

    def count(pairs, name):
        rows = [(r.x, r.y) for r in pairs.select("x", "y").collect()]
        called.append((name, sorted(rows)))
        return spark.createDataFrame([(*p, truth[p]) for p in rows], "x bigint, y bigint, both bigint")

    got = setrelation.derived(near, heads, sizes, count, setjoin.Bar(0.85), lambda df, name: df)
    assert called[0] == ("heads", [(1, 2)]) and (11, 21) not in called[1][1]
    assert {(r.a, r.b) for r in got.collect()} == {(11, 21), (12, 21)}


def test_blocks_are_skipped_and_nothing_lost(monkeypatch):
    monkeypatch.setattr(setjoin, "BLOCK", 8)
    rng, bar = np.random.default_rng(5), setjoin.Bar(0.85)
    m = rng.integers(1, 400, 300)
    pos = (rng.random(300) * (m - -(-17 * m // 20) + 1)).astype(np.int64)
    order, pairs = setjoin.block_pairs(m, pos, bar)
    blocks = math.ceil(300 / 8)
    assert sorted(order.tolist()) == list(range(300)) and len(pairs) < blocks * (blocks + 1) // 2 // 2
    met = {(a, b) for one, two in pairs for a in order[one].tolist() for b in order[two].tolist()}
    for i in range(300):
        for j in range(300):
            least = bar.overlap(m[i], m[j])
            if bar.sizes_fit(m[i], m[j]) and min(m[i] - pos[i], m[j] - pos[j]) >= least:
                assert (i, j) in met or (j, i) in met


def test_a_crowd_is_joined_by_its_least_edited_member(spark, monkeypatch):
    """Copies with three edits are like no other; with one as head of a list, copies with one edit stayed apart and all their pairs were made."""
    made, apart = [], setjoin.apart

    def counted(*args):
        out = apart(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(setjoin, "apart", counted)
    rng, base = random.Random(7), [f"w{i}" for i in range(150)]
    texts = []
    for i in range(300):
        words = list(base)
        for k in rng.sample(range(150), 1 if i % 3 == 0 else 3):
            words[k] = f"x{rng.random()}"
        texts.append(" ".join(words))
    sizes, root = brute_join(texts)
    got = setrelation.join(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (n, r) for i, (n, r) in enumerate(zip(sizes, root, strict=True))}
    assert made[0] < len(texts), made


def test_wide_sketches_refuse_unlike_sets_before_their_texts_travel(spark):
    rng, bar = np.random.default_rng(3), setjoin.Bar(0.85)
    base = rng.integers(-(2**63), 2**63 - 1, 9000)
    sets = [np.sort(base[a:b]) for a, b in ((0, 4400), (200, 4500), (1300, 5700), (2200, 6600), (0, 4050), (0, 1000), (0, 1100), (300, 1300), (0, 8000))]
    rows = [(i, len(s), setjoin.wide(s).tolist(), *setjoin.sketch(s).tolist()) for i, s in enumerate(sets)]
    names = ", ".join(f"{k} bigint" for k in setjoin.SKETCH)
    df = spark.createDataFrame(rows, f"sid bigint, m bigint, wide array<bigint>, {names}")
    pairs = [(i, j) for i in range(len(sets)) for j in range(i)]
    got = {(r.x, r.y) for r in setjoin.alike(spark.createDataFrame(pairs, "x bigint, y bigint"), df, bar).collect()}
    share = {(i, j): len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) for i, j in pairs}
    assert {p for p in pairs if share[p] >= 0.85} <= got and {(1, 0), (4, 0), (6, 5)} <= got
    assert not [p for p in got if share[p] < 0.8], got
    narrow = np.bitwise_count((setjoin.sketch(sets[0]) ^ setjoin.sketch(sets[3])).view(np.uint64)).sum()
    assert narrow <= 2 * 4400 - 2 * bar.overlap(4400, 4400)  # 1,024 bits don't tell them apart


def test_short_and_long_lists_give_the_same_pairs(monkeypatch):
    rng, bar = np.random.default_rng(4), setjoin.Bar(0.85)
    sets = [np.unique(rng.integers(0, 130, 400)) for _ in range(40)]
    columns = [(g, i, len(s), int(rng.integers(0, 9)), int(rng.integers(0, 20)), *setjoin.sketch(s).tolist()) for g in range(5) for i, s in enumerate(sets) if (i + g) % 3]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*columns, strict=True)], [f"c{k}" for k in range(21)])

    def pairs():
        return {p for out in setjoin._apart(bar)(iter([batch])) for p in zip(*(out.column(k).to_pylist() for k in range(2)), strict=True)}

    short = pairs()
    monkeypatch.setattr(setjoin, "FEW", 1)
    monkeypatch.setattr(setjoin, "BLOCK", 8)
    assert short and short == pairs()
    roots = {(c[0], c[1]): c for c in columns}
    want = set()
    for (g, i), a in roots.items():
        for j in range(i):
            if (b := roots.get((g, j))) and a[4] != b[4] and min(a[2] - a[3], b[2] - b[3]) >= (least := bar.overlap(a[2], b[2])):
                differ = np.bitwise_count((setjoin.sketch(sets[i]) ^ setjoin.sketch(sets[j])).view(np.uint64)).sum()
                want |= {(j, i)} if differ <= a[2] + b[2] - 2 * least else set()
    assert short == want


def test_texts_are_described_in_runs_of_bounded_memory():
    """A task held the sets of a whole batch and found words in a megabyte at a time: 74 MB here."""
    bar, common = setjoin.Bar(0.85), SimpleNamespace(value=(np.zeros(0, np.int64), np.zeros(0, np.int64)))
    texts = [" ".join(f"w{(i * 7 + k * k) % 50021}" for k in range(i % 900)) for i in range(5000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5000)), pa.array(texts)], ["doc_id", "t"])
    got, rare = [], 0
    tracemalloc.start()
    for out in setjoin._described(setrelation.sets_of, bar, common)(iter([batch])):
        assert sum(out.column("m").to_pylist()) < setjoin.RUN + 900
        got += zip(*(out.column(c).to_pylist() for c in ("doc_id", "m")), strict=True)
        rare += len(out.column("rare").flatten())
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    sets = list(setrelation.sets_of(batch.column("t")))
    assert got == [(i, len(s)) for i, s in enumerate(sets)] and rare == sum(min(bar.prefix(len(s)), len(s)) for s in sets)
    assert most < 40e6, most


def test_common_items_are_counted_run_by_run(spark, monkeypatch):
    """What is in all texts is a row a run, not a row a text, and the order is what counting all rows gives."""
    monkeypatch.setattr(setjoin, "RUN", 2000)
    texts = [" ".join([f"c{k}" for k in range(8)] + [f"w{i}x{k}" for k in range(30)] + [f"s{i % 20}y{k}" for k in range(4)]) for i in range(400)]
    rows = [dict(zip(("g", "n"), r, strict=True)) for out in setjoin._counted(setrelation.sets_of)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])])) for r in zip(*(c.to_pylist() for c in out.columns), strict=True)]
    want = Counter(np.concatenate(list(setrelation.sets_of(pa.array(texts)))).tolist())
    found = Counter()
    for r in rows:
        found[r["g"]] += r["n"]
    assert found == want and sum(r["g"] == max(want, key=want.get) for r in rows) < 20
    items, often = setjoin.order(spark.createDataFrame([(t,) for t in texts], "t string"), setrelation.sets_of, 12).value
    best = sorted(want.items(), key=lambda x: (-x[1], x[0]))[:12]
    assert dict(zip(items.tolist(), often.tolist(), strict=True)) == dict(best) and items.tolist() == sorted(items.tolist())


def test_jaccard_join_on_odd_rows(odd_docs, no_docs):
    assert setrelation.join(no_docs).count() == 0
    rows = setrelation.join(odd_docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd_docs.collect())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got[1] == got[2] == (7, 1) and got[3] == (0, 3) and got[4] == (0, 4) and got[None] == (2, None)


def brute_negatives(rows):
    kept = []
    for key, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((key, (label + 1) % 10 if key % 7 == 0 else label, [math.floor(256 * x) for x in vector]))
    out = []
    for a, la, va in kept:
        if a % 50:
            continue
        scored = sorted((-sum(p * q for p, q in zip(va, v, strict=True)), key, label == la) for key, label, v in kept if key != a)
        for p, pid, _ in [s for s in scored if s[2]][:5]:
            fits = [(s, n) for s, n, same in scored if not same and 50 * -p <= 100 * -s <= 95 * -p]
            out += [(a, pid, k + 1, n, -p, -s) for k, (s, n) in enumerate(fits[:3])]
    return out


@pytest.mark.parametrize("kind", ["random", "clusters", "ties"])
def test_negatives_match_brute_force(spark, monkeypatch, kind):
    rng = np.random.default_rng(4)
    n = 900
    if kind == "random":
        vectors = rng.normal(size=(n, 12)) * 0.4
    elif kind == "clusters":
        vectors = rng.normal(size=(9, 12))[rng.integers(0, 9, n)] + rng.normal(size=(n, 12)) * 0.03
    else:
        vectors = rng.integers(0, 2, (n, 5)) / 2.0
    rows = [(i, v.tolist(), int(rng.integers(0, 10))) for i, v in enumerate(vectors)]
    rows += [(1000, None, 1), (1050, [1.0] * 5, None), (1051, [None] + [0.5] * 4, 2), (1052, [float("nan")] * 5, 2), (1053, [float("inf")] * 5, 2)]
    monkeypatch.setattr(negatives, "TREE", 200)
    seen = []
    offer = negatives.Windows.offer
    monkeypatch.setattr(negatives.Windows, "offer", lambda *a: (seen.append(a[2].size), offer(*a))[1])
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, score string")
    want = brute_negatives([(k, v and [float(x) if x is not None else None for x in v], c) for k, v, c in rows])
    assert sorted(map(tuple, negatives.mine(df).collect())) == sorted(want)
    assert negatives.mine(df.limit(0)).count() == 0


def test_search_skips_nodes_out_of_the_windows():
    rng = np.random.default_rng(9)
    vectors = np.floor(256 * (rng.normal(size=(12, 16))[rng.integers(0, 12, 4000)] + rng.normal(size=(4000, 16)) * 0.02)).astype(np.int64)
    ids, labels = np.arange(4000), rng.integers(0, 10, 4000)
    tree = negatives.Tree.unpack(negatives.Tree.build(vectors, ids, labels).pack())
    anchors = vectors[:20]
    top = np.full((20, 1), np.iinfo(np.int64).max)
    want = negatives.Windows(ids[:20], labels[:20], -top, top, 5, same=True)
    met, offer = [], want.offer
    want.offer = lambda at, scores, *more: (met.append(scores.size), offer(at, scores, *more))
    tree.search(anchors, want)
    assert sum(met) < 20 * 4000 / 4
    for i in range(20):
        order = sorted((-int(s), int(k)) for s, k in zip(anchors[i] @ vectors.T, ids, strict=True) if labels[k] == labels[i] and k != i)[:5]
        assert [(-int(s), int(k)) for s, k in zip(want.score[i, 0], want.found[i, 0], strict=True)] == order


def test_tree_covers_and_separates():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-300, 300, (1500, 8))
    tree = negatives.Tree.build(vectors, np.arange(1500), np.zeros(1500, np.int64))
    plain = tree.vectors.astype(float)
    points = np.hstack([plain, np.sqrt(tree.norm**2 - (plain**2).sum(axis=1)).clip(0)[:, None]])
    assert sorted(tree.ids.tolist()) == list(range(1500))
    for node in tree.nodes:
        rows = points[node["first"] : node["last"]]
        assert np.linalg.norm(rows - points[node["centre"]], axis=1).max() <= node["radius"] + 1e-6
    for k in range(len(tree.nodes)):
        children = tree.nodes[tree.nodes["parent"] == k]
        if len(children):
            assert children["first"][0] == tree.nodes[k]["first"] and children["last"][-1] == tree.nodes[k]["last"]
            assert (children["first"][1:] == children["last"][:-1]).all() and children["centre"][0] == tree.nodes[k]["centre"]


def test_large_components_are_exact(spark):
    big = 2.0**20
    rows = [(0, [big, 1.0], 0), (1, [big, 0.5], 1), (2, [big * 0.9, 3.0], 1), (3, [big * 0.6, 2.0], 2), (4, [1e300, 1.0], 1), (None, [1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert sorted(map(tuple, negatives.mine(df).collect())) == sorted(brute_negatives([r for r in rows if r[0] not in (4, None)]))


def brute_audit(rows):
    import re

    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    rows = [(lang or "", source or "", Counter(term.findall(lowered(text)))) for text, lang, source in rows]
    found, out = defaultdict(Counter), []
    for lang, _, own in rows:
        found[lang].update(own.keys())
    for lang in {r[0] for r in rows}:
        kept = sorted(t for t, n in found[lang].items() if n >= 10)
        counts, whole = defaultdict(Counter), Counter()
        for g, source, own in rows:
            if g == lang:
                counts[source].update([])
                for t in kept:
                    counts[source][t] += own[t]
                    whole[t] += own[t]

        def shares(own):
            total = sum(own.values())
            return {t: 1 + 10**9 * (own[t] + 2) // (total + 2 * len(kept)) for t in kept}

        apart = lambda p, q: (p - q) ** 2 // (p + q)
        all_shares = shares(whole)
        for a, own in counts.items():
            p = shares(own)
            parts = {"pair": [(-sum(apart(p[t], shares(c)[t]) for t in kept), b) for b, c in counts.items() if b != a]}
            parts["term"] = [(-apart(p[t], all_shares[t]), t) for t in kept if own[t] > 0 and p[t] > all_shares[t]]
            for part, items in parts.items():
                for k, (value, item) in enumerate(sorted(items, key=lambda x: (x[0], x[1].encode()))):
                    if part == "pair" or k < 10:
                        out.append((lang, a, part, item, -value, k + 1))
    return out


def odd_corpus(n=260):
    rng = random.Random(11)
    words = ["the", "The", "river", "river,", "(river)", "a-b", "x1y", "Éa", "éa", "漢字", "don't", "THE!", "q", "rare space", "tab\tbed", "z;"]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s2", "s10", None, "é"])
        rows.append((" ".join(rng.choices(words[: rng.randint(3, len(words))], k=rng.randint(0, 12))), lang, source))
    rows += [(f"once{i % 14} \"once{i % 14}\" once{i % 14}{'.' * (i % 9)}", "de", "s1") for i in range(140)]
    rows += [(None, "fr", "only"), ("", "fr", "other"), (rows[0][0], *rows[0][1:]), (rows[0][0], *rows[0][1:])]
    return rows


def test_audit_matches_brute_force(spark):
    rows = odd_corpus()
    df = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], "doc_id bigint, text string, lang string, source string, rank int").repartition(7)
    want = Counter(brute_audit(rows))
    assert Counter(map(tuple, divergence.audit(df).collect())) == want
    assert Counter(map(tuple, divergence.audit(df, held=40, bucket=3, tile=2).collect())) == want
    assert divergence.audit(df.limit(0)).count() == 0


def test_counts_tell_documents_apart_only_where_needed():
    table = pa.table({"l": ["en"] * 12, "s": ["a"] * 12, "t": [b"go go"] * 11 + [b""], "n": list(range(12))})
    rows = pa.Table.from_batches(divergence._count(table.to_batches())).to_pylist()
    assert [(r["chunk"], r["n"], r["docs"], r["numbers"]) for r in rows] == [(b"go", 22, 11, None), (b"", 1, 1, [11])]


@pytest.mark.parametrize("name", ["op11_jaccard_join", "op12_hard_negatives", "op13_source_divergence"])
def test_queries_match_their_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    want = db.sql(ORACLES[name]).select(*df.columns).fetchall()
    assert want and Counter(map(tuple, df.collect())) == Counter(map(tuple, want))


def test_divergence_lists_only_numbers_of_several_documents(spark):
    """Most chunks of a task are in one document, whose number is a plain column; lists are for two to nine."""
    df = spark.createDataFrame([("en", "s", "go go")] * 11 + [("en", "s", "x y"), ("en", "s", "x"), ("en", None, None)], "lang string, source string, text string").coalesce(1)
    rows = {(r["source"], bytes(r["chunk"])): r for r in divergence.chunk_counts(df).collect()}
    assert {k: (r["n"], r["docs"], r["number"], r["numbers"]) for k, r in rows.items()} == {
        ("s", b"go"): (22, 11, None, None), ("s", b"x"): (2, 2, None, [11, 12]), ("s", b"y"): (1, 1, 11, None), ("", b""): (1, 1, 13, None),
    }
