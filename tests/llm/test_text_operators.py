import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sievework.llm import packing, quality, secrets, simhash, textbatch, toxicity
from sievework.llm.queries import op3_secret_scan, vocabulary
from tests_helpers import brute_components, brute_fingerprint

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    times, marked = Counter(windows), set()
    for k, window in enumerate(windows):
        if times[window] > 1:
            marked.update(range(k, k + 5))
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)]


def test_base_counts_match_brute_force(odd_docs, spark, sf_dir):
    texts = [r.text for r in odd_docs.collect()] + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150).collect()]
    texts += ["a b c d e a b c d e f", "x\nx\n\nx\n y\n y", "#*$%&|<>" * 5]
    got = quality.judge_batch(pa.array(texts, pa.string()), quality.accept_all(), 0.5).to_pylist()
    for text, row in zip(texts, got, strict=True):
        want = brute_counts(text or "")
        assert [row[c] for c in quality.COUNTS] == want
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert row["base_failed"] == failed and row["kept"] == (not failed)


def test_quality_keeps_columns_and_empty_tables(odd_docs, no_docs):
    assert quality.keep_good(no_docs, quality.accept_all()).count() == 0
    kept = quality.keep_good(odd_docs, quality.accept_all())
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2}


def test_quality_learns(spark):
    rng = np.random.default_rng(1)
    good = [" ".join(rng.choice(["river", "stone", "cloud", "tree", "lamp"], 30)) for _ in range(100)]
    bad = [" ".join(x + "$$$" for x in rng.choice(["river", "stone", "cloud", "tree", "lamp"], 30)) for _ in range(100)]
    model = quality.fit(good[:70] + bad[:70], [1] * 70 + [0] * 70)
    got = quality.judge_batch(pa.array(good[70:] + bad[70:]), model, 0.5).field("quality").to_pylist()
    assert all(p > 0.5 for p in got[:30]) and all(p < 0.5 for p in got[30:])


def test_toxicity_learns_and_handles_odd_rows(spark, odd_docs, no_docs):
    rng = np.random.default_rng(2)
    plain = ["river", "stone", "cloud", "tree", "lamp", "road", "door"]
    texts = [" ".join(rng.choice(plain, 25)) for _ in range(400)]
    labels = [int(i % 3 == 0) for i in range(400)]
    texts = [t + " zounds" if y else t for t, y in zip(texts, labels, strict=True)]
    model = toxicity.fit(texts, labels)
    assert 0 < len(model.index) < 200
    scores = toxicity.score_batch(pa.array(["river stone ZOUNDS!", "river stone cloud", "", None]), model.dense(), model.bias, model.bits)
    assert scores[0] > 0.7 and max(scores[1:]) < 0.7
    out = toxicity.score(odd_docs, model, into="toxic")
    assert out.count() == odd_docs.count() and out.columns == [*odd_docs.columns, "toxic"]
    assert toxicity.drop_toxic(odd_docs, model).count() == odd_docs.count()
    assert toxicity.drop_toxic(no_docs, model).count() == 0


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    from sievework.llm.queries import op10_toxicity

    got = op10_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    # about 300 toxic rows to learn from here
    toxic = got[got.toxic == 1]
    assert (toxic.predicted == 1).mean() > 0.88
    assert (got[got.toxic == 0].predicted == 1).mean() < 0.01


def test_repeated_token_beginnings_take_linear_time():
    import time

    start = time.perf_counter()
    assert secrets.wider_spans("eyJ" * 350_000) == [] and secrets.wider_spans("eyJaaaaaaaa." * 90_000)
    assert time.perf_counter() - start < 1.0
    token = "eyJ" + "a" * 8 + "." + "b" * 8 + "." + "c" * 8
    assert [x[:3] for x in secrets.wider_spans(f"x {token} y")] == [("jwt", 2, 2 + len(token))]


def test_ftrl_equals_a_plain_one():
    """Scores against a per-coordinate FTRL over strings, one feature at a time."""
    import math

    rng = np.random.default_rng(9)
    names = [f"{a}{b}" for a in ("anlage", "boden", "ço", "x", "katze") for b in ("", "n", "chen", "ß")]
    texts = [" ".join(rng.choice(names, rng.integers(0, 12))) for _ in range(120)]
    labels = [int("katze" in t or rng.random() < 0.1) for t in texts]
    alpha, beta, l1, l2 = 3.0, 1.0, 0.7, 0.1

    def features(text):
        words = [w.encode() for w in text.lower().split()]
        all_ = [("w", w) for w in words] + [("p", a, b) for a, b in zip(words, words[1:])] + [("s", a, b) for a, b in zip(words, words[2:])]
        all_ += [("t", n, w[:n]) for w in words for n in toxicity.STEMS if len(w) > n]
        times = Counter(all_)
        return [*times, *(("twice", k) for k, v in times.items() if v > 1)]

    z, s = Counter(), Counter()
    bz = bs = bias = 0.0

    def weight(k):
        return 0.0 if abs(z[k]) <= l1 else (math.copysign(l1, z[k]) - z[k]) / ((beta + math.sqrt(s[k])) / alpha + l2)

    for _ in range(3):
        for text, y in zip(texts, labels, strict=True):
            own = features(text)
            w = [weight(k) for k in own]
            g = 1 / (1 + math.exp(-(sum(w) + bias))) - y
            for k, v in zip(own, w, strict=True):
                z[k] += g - (math.sqrt(s[k] + g * g) - math.sqrt(s[k])) / alpha * v
                s[k] += g * g
            bz += g - (math.sqrt(bs + g * g) - math.sqrt(bs)) / alpha * bias
            bs += g * g
            bias = -bz / ((beta + math.sqrt(bs)) / alpha)
    model = toxicity.fit(texts, labels, alpha=alpha, beta=beta, l1=l1, l2=l2, passes=3)
    assert len(model.index) == sum(weight(k) != 0 for k in z) and abs(model.bias - bias) < 1e-6
    new = [*texts[:20], "katzen boden xß", "", "nothing known"]
    got = toxicity.score_batch(pa.array(new), model.dense(), model.bias, model.bits)
    want = [1 / (1 + math.exp(-(sum(weight(k) for k in features(t)) + bias))) for t in new]
    assert np.abs(got - want).max() < 1e-4


def test_quality_equals_a_plain_regression():
    """Probabilities against Adagrad and Platt's curve over dictionaries of words, pairs and trigrams."""
    import math

    rng = np.random.default_rng(10)
    names = ["river", "stone", "cloud", "año", "$$$", "x"]
    texts = [" ".join(rng.choice(names, rng.integers(1, 15))) for _ in range(100)]
    labels = [int(t.count("$") <= 3 or rng.random() < 0.2) for t in texts]

    def features(text):
        data, words = text.encode(), text.split()
        out = {}
        for kind, items in (("w", words), ("p", list(zip(words, words[1:]))), ("c", [data[k : k + 3] for k in range(len(data) - 2)])):
            for item, n in Counter(items).items():
                out[kind, item] = n / len(items)
        return out

    rows = [features(t) for t in texts]
    w, g2, bias = Counter(), {}, 0.0
    order = np.random.default_rng(7).permutation(len(texts))
    learn, rest = order[20:], order[:20]
    for turn in range(6):
        rate = 2.0 / (1 + turn)
        for i in learn:
            g = 1 / (1 + math.exp(-(sum(w[k] * x for k, x in rows[i].items()) + bias))) - labels[i]
            for k, x in rows[i].items():
                step = g * x + 1e-6 * w[k]
                g2[k] = g2.get(k, 1e-6) + step * step
                w[k] -= rate * step / math.sqrt(g2[k])
            bias -= 0.02 * rate * g
    margin = lambda row: sum(w[k] * x for k, x in row.items()) + bias
    m, y = np.array([margin(rows[i]) for i in rest]), np.array([labels[i] for i in rest], float)
    slope, shift = quality.platt(m, y)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    loss = lambda a, b: -(target * np.log(1 / (1 + np.exp(-a * m - b))) + (1 - target) * np.log(1 - 1 / (1 + np.exp(-a * m - b)))).sum()
    assert all(loss(slope, shift) <= loss(slope + da, shift + db) + 1e-3 for da in (-0.1, 0, 0.1) for db in (-0.1, 0, 0.1))
    model = quality.fit(texts, labels)
    got = quality.judge_batch(pa.array(texts), model, 0.5)
    want = np.array([1 / (1 + math.exp(-(slope * margin(r) + shift))) for r in rows])
    assert np.abs(np.array(got.field("quality").to_pylist()) - want).max() < 1e-3
    counts = [brute_counts(t) for t in texts]
    failed = [c[0] < 10 or 100 * c[4] > 20 * c[0] for c in counts]
    assert got.field("kept").to_pylist() == [not f and p >= 0.5 for f, p in zip(failed, got.field("quality").to_pylist(), strict=True)]
    assert [f.name for f in got.type][-1] == "quality"


def test_training_brings_one_row_an_id_to_the_driver(spark, monkeypatch):
    """An id on 100,000 rows is one row of the sample."""
    docs = spark.range(100_000).selectExpr("1L as doc_id", "concat('word ', id) as text").unionByName(spark.range(2, 40).selectExpr("id as doc_id", "concat('text ', id) as text"))
    labels = spark.range(1, 40).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "cast(id % 2 as int) as toxic")
    for module, rows, most in ((quality, 10, 10), (toxicity, 5, 10)):
        seen = []
        monkeypatch.setattr(module, "fit", lambda texts, marks, seen=seen: seen.append((len(texts), len(marks))))
        module.train(docs, labels, rows=rows)
        assert seen and seen[0][0] == seen[0][1] <= most
        module.train(docs, labels, rows=100)
        assert len(seen) == 2 and 10 < seen[1][0] <= 39


def test_training_never_sees_held_out_labels(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ids = [r.doc_id for r in labels.filter(~toxicity.held_out()).collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)


def test_near_duplicates_match_brute_force(spark, odd_docs):
    base = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(250).collect()]
    rows = [(i, t) for i, t in enumerate(base)] + [(r.doc_id, r.text) for r in odd_docs.filter("length(text) < 1000 or text is null").collect()]
    prints = [(d, brute_fingerprint(t)) for d, t in rows]
    want = Counter((d, f"{p:016x}", c) for (d, p), c in zip(prints, brute_components(prints).values(), strict=True))
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = got.select("doc_id", simhash.as_hex(got.fingerprint).alias("f"), "component_id").collect()
    assert Counter(map(tuple, got)) == want


@pytest.mark.parametrize("tile", [4, 2048])
def test_links_of_crowded_groups(spark, tile):
    """Chains and crowds, in tiles of any size, connect as brute force says."""
    rng = np.random.default_rng(5)
    values = {0, -1}
    for centre in rng.integers(-(2**62), 2**62, 6).tolist():
        for _ in range(25):
            values.add(int(np.int64(np.uint64(centre & (2**64 - 1)) ^ np.uint64(1 << int(rng.integers(0, 16))) ^ np.uint64(1 << int(rng.integers(0, 16))))))
    values = sorted(values)
    pairs = simhash.links(spark.createDataFrame([(v,) for v in values], "fp bigint"), tile=tile)
    roots = {r.fp: r.root for r in simhash.components(pairs, spark).collect()}
    want = brute_components([(v, v & (2**64 - 1)) for v in values])
    assert {v: roots.get(v, v) for v in values} == {v: want[i] for i, v in enumerate(values)}


def test_keep_one_is_repeatable(spark):
    """One row of each group stays, the same whatever the partitions, though rows share their id; equal rows become one."""
    words = "lorem ipsum dolor sit amet consectetur adipiscing elit".split()
    rows = [(1, f"{w} {w[::-1]} {w * 2} {k}", "a", {"a": k}) for k, w in enumerate(words)] * 3 + [(None, "x", "", None), (2, "only one here", "b", {"b": 1}), (2, "only one here", "c", {"b": 1})] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, MARK map<string, int>")
    seen = set()
    for n in (1, 3, 7):
        kept = simhash.keep_one(frame.repartition(n))
        assert kept.columns == frame.columns
        got = sorted((r.doc_id or 0, r.text, r.source) for r in kept.collect())
        assert [x[0] for x in got] == [0, 0, *[1] * len(words), 2]
        seen.add(tuple(got))
    assert len(seen) == 1


def test_fingerprints_in_reach_share_two_segments():
    rng = np.random.default_rng(6)
    for value in rng.integers(0, 2**63, 200).tolist():
        other = value
        for bit in rng.choice(64, 3, replace=False).tolist():
            other ^= 1 << bit
        assert sum((value ^ other) >> at & (1 << bits) - 1 == 0 for at, bits in simhash.SEGMENTS) >= 2
    assert sum(bits for _, bits in simhash.SEGMENTS) == 64


def test_keep_one(spark, odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [1, 3, 6, 7, 8, 9, 10, None]
    assert simhash.keep_one(no_docs).count() == 0


def test_secret_spans_match_brute_force(spark, odd_docs, no_docs):
    texts = [
        "token=token:abcdefgh", 'API_KEY" : "abcdef12"', "PassWord=abc", "x" + "0123456789abcdef" * 2, "AKIA" + "Z" * 15, "AKIA" + "Z" * 16 + "q",
        "secret:=aaaaaa passwd='bbbbbbb' api_key=cccccc", "ſecret=abcdefgh K", "é" * 5 + "token=ffffffffffffffffffffffffffff",
    ]
    for text in texts + [r.text or "" for r in odd_docs.collect()]:
        want = []
        for m in re.finditer(r"((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
            if len(m[2]) >= 6:
                want.append((m.start(), 0, "assign", m.end()))
        want += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert [(a, secrets.KINDS.index(k), k, b) for k, a, b, _ in secrets.base_spans(text)] == sorted(want)
    assert secrets.scan(no_docs, ["doc_id"], ["source"], ["lang"]).count() == 0
    assert secrets.scan(odd_docs, ["doc_id"], ["source"], ["lang"]).count() == odd_docs.count()


def test_ownership_separates_examples_from_live_credentials(spark):
    common, own = "AKIA" + "C" * 16, "AKIA" + "L" * 16
    rows = [(i, f"see {common} here", "en", f"s{i}") for i in range(6)] + [(9, f"{own} and {common}", "en", "s1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    spans = {r.doc_id: [(x.kind, x.n_owners, x.live) for x in r.spans] for r in secrets.scan(docs, ["doc_id"], ["source"], ["lang"]).collect()}
    assert spans[0] == [("access", 6, False)] and spans[9] == [("access", 1, True), ("access", 6, False)]
    texts = {r.doc_id: r.text for r in secrets.redact(docs, ["source"], ["lang"]).collect()}
    assert texts[0] == f"see {common} here" and texts[9] == f"[SECRET:access] and {common}"


def test_redact_keeps_odd_rows(odd_docs, no_docs):
    out = secrets.redact(odd_docs, ["source"], ["lang"])
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert secrets.redact(no_docs, ["source"], ["lang"]).count() == 0


def test_packing_is_gapless_and_whole(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = odd_docs.repartition(5)
    rows = packing.pack(docs, path).collect()
    want = []
    for r in odd_docs.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, (start, n) in enumerate(packing.pieces_of(len(ids))):
            want.append((r.doc_id, k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == Counter(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.SIZE
    assert packing.pack(no_docs, path).count() == 0


def test_secret_query_matches_brute_force(spark, sf_dir, odd_docs, tmp_path):
    """Counts, digest and spans of the query against patterns written out here and counts of owners in dictionaries."""
    import hashlib

    key = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A\n\nab+/==\n-----END RSA PRIVATE KEY-----"
    shared, wide = "https://bob:" + "p" * 200 + "@host", "BEARER " + "t0ken." * 5
    made = [(100 + i, f"é {shared} x", "en", f"s{i}") for i in range(5)] + [(200 + i, f"{key} and {wide}", f"l{i}", "one") for i in range(12)]
    made += [(300 + i, f"Bearer {'q' * 30}", f"l{i % 6}", f"t{i // 6}") for i in range(12)] + [(400, "eyJ" + "a" * 9 + "." + "b" * 9 + "." + "c" * 9 + " ftp://u:pw3@h", None, None)]
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    docs = base.unionByName(spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string")).unionByName(odd_docs.select("doc_id", "text", "lang", "source"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kinds = {
        "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
        "access": ("AKIA[A-Z0-9]+", 0, 0, 20), "hex": ("[0-9a-f]+", 0, 0, 24),
        "private_key": ("-----BEGIN RSA PRIVATE KEY-----.*?-----END RSA PRIVATE KEY-----", re.S, 0, 0),
        "jwt": (r"eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8,}", re.A, 0, 0), "url_login": (r"(?:https|ftp)://[^\s:/@]+:([^\s:/@]{3,})@", 0, 1, 0),
        "bearer": (r"\bbearer [A-Za-z0-9._~+/-]{20,}=*", re.I, 0, 0),
    }
    found, owners, places = [], {}, {}
    for row in docs.collect():
        spans = []
        for turn, (kind, (pattern, flags, group, least)) in enumerate(kinds.items()):
            spans += [(m.start(), turn, kind, m.end(), m[group]) for m in re.finditer(pattern, row.text or "", flags) if len(m[group]) >= least]
        for x in spans:
            owners.setdefault(x[4], set()).add(row.source)
            places.setdefault(x[4], set()).add((row.source, row.lang))
        found.append((row.doc_id, sorted(spans)))
    want = Counter()
    for key, spans in found:
        copied = {x for x in spans if len(owners[x[4]]) >= 5 or len(owners[x[4]]) > 1 and len(places[x[4]]) >= 10}
        first = [x for x in spans if x[1] < 3]
        shown = [x for x in spans if x[1] < 3 or x not in copied]
        text = [",".join(f"{x[2]}:{x[0]}:{x[3]}" for x in part) for part in (first, shown)]
        counts = Counter(x[2] for x in first)
        want[key, counts["assign"], counts["access"], counts["hex"], hashlib.sha256(text[0].encode()).hexdigest(), text[1]] += 1
    got = op3_secret_scan(spark, str(tmp_path))
    assert Counter(map(tuple, got.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect())) == want
    spans = {r.doc_id: r.spans for r in got.collect()}
    assert spans[100] == spans[300] == "" and "private_key" in spans[200] and "bearer" in spans[200] and "jwt" in spans[400] and "url_login" in spans[400]


@pytest.mark.parametrize("leaves", [32, 512])
def test_merges_stay_small(leaves):
    """What a merge receives doesn't grow with the leaves, and the bins stay within one in a hundred of the least number."""
    rng = np.random.default_rng(4)
    total = bins = 0
    level = []
    for leaf in range(leaves):
        sizes = np.minimum(rng.lognormal(6, 1.2, 400).astype(int) + 1, packing.SIZE).tolist()
        total += sum(sizes)
        made = packing._bin_rows([(n, []) for n in sizes], False, leaf).to_pylist()
        bins += sum(r["done"] for r in made)
        level.append([(r["fill"], []) for r in made if not r["done"]])
    while len(level) > 1:
        groups = [sum(level[k : k + packing.FAN], []) for k in range(0, len(level), packing.FAN)]
        assert max(map(len, groups)) <= packing.FAN * (1 + packing.HOSTS)
        level = []
        for items in groups:
            made = packing._bin_rows(items, len(groups) == 1, 0).to_pylist()
            bins += sum(r["done"] for r in made)
            level.append([(r["fill"], []) for r in made if not r["done"]])
    assert not level[0] and bins <= 1.01 * -(-total // packing.SIZE)


@pytest.mark.parametrize("flush", [7, 50_000])
def test_tasks_pack_in_parts(flush):
    rng = np.random.default_rng(5)
    texts = [" ".join(["stone"] * int(n)) for n in rng.integers(0, 3000, 300)] + [None, ""]
    batches = [pa.record_batch([pa.array(range(k, k + 2), pa.int64()), pa.array(texts[k : k + 2])], ["doc_id", "text"]) for k in range(0, len(texts), 2)]
    path = vocabulary("byte_bpe_50k.json")
    bins = [row for b in packing.pack_batches(batches, path, 3, True, flush) for row in b.to_pylist()]
    pieces = [p for b in bins for p in b["pieces"]]
    assert all(b["done"] and b["leaf"] == 3 for b in bins)
    assert Counter((p["doc_id"], p["piece"], p["length"]) for p in pieces) == Counter(
        (i, k, n) for i, t in enumerate(texts) for k, (_, n) in enumerate(packing.pieces_of(len(packing.token_ids(t, path)) + 1))
    )
    for b in bins:
        at = 0
        for p in sorted(b["pieces"], key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == b["fill"] <= packing.SIZE


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        packing.encoder(vocabulary("word_bpe_49k.json"))


def test_packing_is_tight(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(20)
    rows = packing.pack(docs, vocabulary("byte_bpe_50k.json"))
    total, bins = rows.selectExpr("sum(length)", "count(distinct sequence_id)").first()
    assert bins <= -(-total // packing.SIZE) * 1.03 + 1


def test_token_ids_equal_the_tokenizers_library(spark):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(200).collect()]
    texts += ["", " ", "a  b\n\n c\t\x1c\x85\xa0d ", "I'll we've 'S x's", "<|endoftext|> x <|endoftext|>", "漢字 🙂 12,345", "  　a", "\r\n\r\nx\r"]
    for text in texts:
        assert packing.token_ids(text, path).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_components_need_few_jobs(spark):
    """A round looks for no hot value: the driver plans, broadcasts and holds little, however the links lie."""
    pairs = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)], "a bigint, b bigint")
    context = spark.sparkContext
    context.setJobGroup("components", "links of a chain and a star")
    try:
        roots = {r.fp: r.root for r in simhash.components(pairs, spark).collect()}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert roots == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    jobs = len(context.statusTracker().getJobIdsForGroup("components"))
    assert jobs <= 90, jobs


def test_freed_memory_goes_back():
    """What training leaves in small pieces isn't kept by the process."""
    def held():
        return int(next(x for x in open("/proc/self/status") if x.startswith("VmRSS")).split()[1]) / 1024

    parts = [np.ones(2_000, np.int64) for _ in range(10_000)]  # 160 MB
    last, before = parts[-1].copy(), held()
    del parts
    textbatch.give_back()
    assert held() < before - 100 and last.sum() == 2_000
