import hashlib
import html as html_lib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import bpe, html_extract, licenses, media, textbatch, warc
from sievework.llm.queries import op5_media_columns, vocabulary

# HTML ----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scorer():
    return html_extract.Scorer(html_extract.default_model())


def test_held_out_blocks_are_labelled_right(scorer):
    wrong = total = 0
    for page in html_extract.labelled_pages(60, seed=99):
        blocks = html_extract.leaf_blocks(page)
        for block, label in zip(blocks, scorer.viterbi(blocks), strict=True):
            total += 1
            wrong += block.label != label
    assert wrong <= 0.01 * total


def test_pages_match_their_articles(spark, scorer):
    def article(page):
        inside = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub("<br>", " ", re.sub("</?b>", "", inside)))
        return "\n\n".join(t for t in (" ".join(html_lib.unescape(b).split()) for b in blocks) if t)

    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        assert scorer.extract(row.html) == article(row.html)


def test_odd_pages(spark, scorer):
    pages = [
        (1, "<article><p>One&nbsp;two &amp; three<br>four <script>var x='<p>no</p>'</script>five.</p><aside>Buy now.</aside><p>Six", "u"),
        (1, "<article><p>One&nbsp;two &amp; three<br>four <script>var x='<p>no</p>'</script>five.</p><aside>Buy now.</aside><p>Six", "u"),
        (2, None, None), (3, "", "u"), (4, "<<<>>><a href=", "u"), (5, "<nav>Home</nav><footer>Imprint</footer>", "u"),
        (6, "<main><p>" + "long text here. " * 20_000 + "</p></main>", "u"),
    ]
    frame = spark.createDataFrame(pages, "page_id bigint, html string, path string")
    out = html_extract.extract(frame, into="main")
    assert out.columns == ["page_id", "html", "path", "main"]
    got = Counter((r.page_id, r.main) for r in out.collect())
    assert got[1, "One two & three four five.\n\nSix"] == 2
    assert got[2, ""] == got[3, ""] == got[5, ""] == 1
    assert got[6, ("long text here. " * 20_000).strip()] == 1
    assert html_extract.extract(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<a" * 200_000, "<a '" * 200_000, '<a x="' * 200_000 + ">", "<a" + "b" * 5_000_000 + ">", '<p class="' + "ab cd " * 800_000 + '">x</p>', "<div>x" * 200_000,
        "<section>" + "<div>" * 100_000 + "</section>" * 100_000, "<div>" * 100_000 + "</ul>" * 100_000, "<!--" * 200_000, "<script>" * 200_000, "</script " * 100_000,
        "<p>&" + "#" * 200_000, "<p>&#" + "9" * 200_000 + ";", "<p class" + " " * 200_000 + "=" * 200_000, "<" * 1_000_000, "<!" * 200_000, "<p style='" + "display:" * 100_000 + "'>x",
    ],
    ids=range(17),
)
def test_broken_and_deep_pages_take_linear_time_and_space(scorer, page):
    import time
    import tracemalloc

    start = time.process_time()
    scorer.extract(page)
    assert time.process_time() - start < 4
    tracemalloc.start()
    scorer.extract(page[: len(page) // 2])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150_000_000


def test_broken_markup_is_read_as_far_as_it_goes(scorer):
    def blocks(page):
        return [b.text for b in html_extract.leaf_blocks(page)]

    assert blocks("<p>a < b <3 <p title='x>y'>two</p><p class=\"z>three</p><p>four <a href='u") == ["a < b <3", "two", "three", "four"]
    assert blocks("<p>x&#99999999999999;y&#x41;z</p><svg/>after<svg><p>no</svg><p>end") == ["x\ufffdyAz", "after", "end"]
    assert blocks("<div hidden class=a id='b c' ROLE=d>t") == ["t"]
    node = html_extract.leaf_blocks("<div class=a><p class='a b'>t")[0].node
    assert html_extract.node_features(node) == ["tag:div", "tag:p", "word:a", "word:b", "leaf:p"]


def test_viterbi_is_the_best_of_all_paths(scorer):
    from itertools import product

    page = html_extract.labelled_pages(3, seed=5)[1]
    blocks = html_extract.leaf_blocks(page)[:9]
    model = scorer.model

    emissions = scorer.emissions(blocks)

    def value(path):
        total = model.start[path[0]]
        for k, label in enumerate(path):
            total += emissions[k] * label + (model.step[path[k - 1]][label] if k else 0)
        return total

    best = max(product((0, 1), repeat=len(blocks)), key=value)
    assert abs(value(scorer.viterbi(blocks)) - value(best)) < 1e-9


# Media ---------------------------------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=700))
def test_payloads_round_trip(data):
    payload = media.pad(data)
    stored = media.encode(payload, len(data))
    image = media.decode(stored)
    assert media.payload_of(image) == (payload, len(data))
    assert media.tensor(image).shape == (image.height, image.width, 3)


def test_another_decoder_reads_the_same_luma(spark):
    """The Java runtime's JPEG reader accepts the files and finds the same samples."""
    jvm = spark._jvm
    for n in (64, 64 * 50, 64 * 700):
        text = bytes(np.random.default_rng(n).integers(97, 123, n, dtype=np.uint8))
        stored = media.encode(text, n)
        reader = jvm.javax.imageio.ImageIO.getImageReadersByFormatName("jpeg").next()
        reader.setInput(jvm.javax.imageio.ImageIO.createImageInputStream(jvm.java.io.ByteArrayInputStream(bytearray(stored))))
        raster = reader.readRaster(0, None)
        theirs = np.frombuffer(bytes(raster.getDataBuffer().getData()), np.uint8).reshape(raster.getHeight(), raster.getWidth(), 3)[:, :, 0]
        image = media.decode(stored)
        gray = media.Image(image.height, image.width, [image.components[0] | {"most": [2, 2]}], quant=image.quant)
        ours = media.tensor(gray)[:, :, 0]
        assert np.abs(ours.astype(int) - theirs.astype(int)).max() <= 2


def test_tables_with_many_codes_and_restarts_decode():
    """A hand-made scan with zero runs, end-of-band runs and restarts goes through the general reader."""
    frame = media._segment(0xC2, bytes([8, 0, 8, 0, 16, 1, 1, 0x11, 0]))
    tables = media._segment(0xC4, media._table(0, 0, {4: [*range(9)]}) + media._table(1, 0, {4: [0x01, 0x11, 0x00, 0x10, 0xF0, 0x02]}))
    def bits(text):
        text = text.replace(" ", "")
        return int(text + "1" * (-len(text) % 8), 2).to_bytes((len(text) + 7) // 8, "big")

    # DC of two blocks in restart intervals of one block: differences 3 and -2, each from zero
    dc = bits("0010 11") + b"\xff\xd0" + bits("0010 01")
    # AC: block one: coefficient 1 is 1, then a zero, coefficient 3 is -1, end; block two: 16 zeros, then coefficient 17 is 2, end
    ac = bits("0000 1 0001 0 0010") + b"\xff\xd0" + bits("0100 0101 10 0010")
    # refining: block one: correction 1 for coefficient 1; new -1 at coefficient 2; correction 0; end of band for one block
    refine = bits("0000 0 1 0010 0") + b"\xff\xd0" + bits("0010 1")
    stored = b"\xff\xd8" + media._QUANT + frame + tables + media._segment(0xDD, b"\0\1")
    stored += media._segment(0xDA, bytes([1, 1, 0, 0, 0, 0])) + dc + media._segment(0xDA, bytes([1, 1, 0, 1, 63, 1])) + ac
    stored += media._segment(0xDA, bytes([1, 1, 0, 1, 63, 0x10])) + refine + b"\xff\xd9"
    data = media.decode(stored).components[0]["data"]
    assert data[0, 0] == 3 and data[1, 0] == -2
    assert data[0, :5].tolist() == [3, 3, -1, -2, 0]
    assert data[1, 17] == 5 and not data[1, 1:17].any() and not data[1, 18:].any()


@pytest.mark.parametrize("density", [0.0, 0.003, 0.05, 0.5, 1.0])
def test_sparse_and_dense_scans_round_trip(density):
    """Zero runs of over fifteen, ends of bands over many blocks, and new and corrected coefficients, in restart segments."""
    rng = np.random.default_rng(int(1000 * density))
    blocks, values = 40, rng.choice([-150, -9, -3, -2, -1, 1, 2, 3, 7, 120], (40, 64))
    data = np.where(rng.random((blocks, 64)) < density, values, 0).astype(np.int16)
    data[7:20, 1:] *= rng.integers(0, 2)
    frame = media._segment(0xC2, bytes([8, 0, 8, (8 * blocks) >> 8, 8 * blocks & 255, 1, 1, 0x11, 0]))
    dht = media._segment(0xC4, b"".join(media._table(k >> 4, k & 15, t) for k, t in media.tables().items()))
    stored = b"\xff\xd8" + media._QUANT + frame + dht + media._segment(0xDD, b"\0\x10")
    for low, high, before, left in ((1, 63, 0, 2), (1, 63, 2, 1), (1, 40, 1, 0), (41, 63, 1, 0)):
        rows = [np.arange(i, min(i + 16, blocks)).reshape(-1, 1) for i in range(0, blocks, 16)]
        parts = media._coded_segments(data, ((0,), low, high, before, left), rows)
        stored += media._segment(0xDA, bytes([1, 1, 1 if before else 0, low, high, before << 4 | left]))
        stored += b"".join((bytes([0xFF, 0xD0 + k - 1]) if k else b"") + x.replace(b"\xff", b"\xff\0") for k, x in enumerate(parts))
    got = media.decode(stored + b"\xff\xd9").components[0]["data"]
    assert np.array_equal(got[:, 1:], data[:, 1:])


def test_own_tables_are_complete_prefix_codes():
    for lengths in media.tables().values():
        assert max(lengths) <= 16 and sum(len(v) / 2**n for n, v in lengths.items()) < 1
    assert {s for v in media.tables()[0x10].values() for s in v} >= {run << 4 | size for run in range(16) for size in range(1, 9)} | {n << 4 for n in range(16)}


def test_sides_hold_what_a_cell_can():
    wide, high = media.sides((1 << 31) // media.UNIT)
    assert 16 * max(wide, high) < 65536 and wide * high * 6 * media.UNIT >= 1 << 31


def test_files_of_long_texts_have_no_size_limit():
    """A text over 402,653,184 bytes: its frame is read; a foreign one of so many pixels is refused, and so is a false comment."""
    size = 450_000_000 // 64 * 64
    wide, high = (16 * x for x in media.sides(size // media.UNIT))
    assert wide * high > media.MOST_PIXELS
    frame = bytes([8]) + high.to_bytes(2, "big") + wide.to_bytes(2, "big") + bytes([3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    image = media._frame(frame, b"payload %d of %d" % (size - 5, size))
    assert (image.width, image.height) == (wide, high) and sum(c["rows"] * c["columns"] for c in image.components) * media.UNIT >= size
    for comment in (b"", b"payload 9 of 64", b"payload %d of %d" % (size + 1, size), b"payload 1 of %d" % (1 << 31), b"payload 0 of 0"):
        with pytest.raises(ValueError):
            media._frame(frame, comment)


def test_damaged_media_are_null(spark):
    text = " ".join(f"word{i}" for i in range(3000)).encode()
    whole = media.encode(media.pad(text), len(text))
    rng = np.random.default_rng(1)
    files = [None, b"", b"no file", whole[:-2], whole[: len(whole) // 2], whole.replace(b"\xff\xc2", b"\xff\xc0"), whole[:700], b"\xff\xd8\xff\xd9"]
    for _ in range(60):
        at = int(rng.integers(0, len(whole) - 40))
        files.append(whole[:at] + rng.bytes(int(rng.integers(1, 30))) + whole[at + 20 :])
    found = media.decode_many([*files, whole])
    assert all(isinstance(x, ValueError) for x in found[:8]) and media.payload_of(found[-1])[0] == media.pad(text)
    frame = spark.createDataFrame([(i, bytearray(x) if x is not None else None) for i, x in enumerate([*files[:8], whole])], "i int, media binary")
    rows = media.tensors(media.load(frame)).orderBy("i").collect()
    assert all(r.loaded is None and r.tensor is None for r in rows[:8]) and rows[8].loaded.payload_bytes == len(media.pad(text))


def test_tensors_are_stored_and_read_back(spark, odd_docs, tmp_path):
    stored = media.store(odd_docs.filter("doc_id < 7"))
    rows = media.store_tensors(stored, f"{tmp_path}/tensors").collect()
    assert len(rows) == 7
    for r in rows:
        want = media.tensor(media.decode(bytes(r.media)))
        assert want.shape == (r.tensor.height, r.tensor.width, 3) and want.tobytes() == bytes(r.tensor.pixels)


def test_media_query_matches_brute_force(spark, odd_docs, no_docs, tmp_path):
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = op5_media_columns(spark, str(tmp_path)).collect()
    want = Counter()
    for r in odd_docs.collect():
        data = (r.text or "").encode()
        payload = data + b"\0" * (-len(data) % 64 if data else 64)
        want[r.doc_id, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == want
    by_text = {(r.payload_sha256, r.n_bytes): set() for r in rows}
    for r in rows:
        by_text[r.payload_sha256, r.n_bytes].add((r.media_sha256, r.feature))
    assert all(len(x) == 1 for x in by_text.values())
    assert media.load(media.store(no_docs)).count() == 0
    shown = media.tensors(media.store(odd_docs.filter("doc_id = 1"))).first().tensor
    assert len(shown.pixels) == 3 * shown.height * shown.width


# WARC ----------------------------------------------------------------------------------------------


def test_archive_matches_brute_force(spark):
    shared, tiny = "x" * 100, "y" * 99
    rows = [
        (5, "http://a/ b\t", shared), (3, "http://b", shared), (9, None, shared), (3, "http://b", shared), (1, "u", tiny), (2, "u", tiny),
        (4, "u", None), (6, "u", ""), (7, "u", "\n\nURL 0 0 0 5\r\n\r\nWARC/1.1\r\n" * 20), (None, "u", shared), (-8, "u", "é" * 60), (2**62 + 5, "u", "é" * 60), (-(2**63), "u", "ü" * 90), (8, "u", "ü" * 90),
    ]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, archive string")
    want = Counter()
    for key, _, body in rows:
        data = (body or "").encode()
        first = min(k for k, _, b in rows if b == body and k is not None) if len(data) >= 100 else None
        revisit = first is not None and key is not None and key > first
        want[key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None] += 1
    got = warc.archive(pages.repartition(3)).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert warc.archive(pages.limit(0)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions_parse(version):
    rows = [(1, "http://x/é z", b"a\n\nb"), (None, None, b""), (3, "u", b"\n")]
    found = list(warc.parse_arc(b"".join(warc.arc_file("n.arc", version, rows))))
    assert [warc.split_http(b)[1:] for _, b in found] == [(body, key) for key, _, body in rows]
    assert found[0][0]["URL"] == "http://x/%C3%A9%20z" and ("Result-code" in found[0][0]) == (version == 2)
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"".join(warc.arc_file("n.arc", version, rows))[:-4]))


def test_foreign_archives_are_converted(spark):
    """Heads without a length and with bare line ends, dns and other schemes, short stamps, two files in one, one of them not compressed."""
    import gzip

    fields = "URL IP-address Archive-date Content-type Archive-length"
    blocks = [
        ("http://a/x y", "199701020304", "text/html", b"HTTP/1.0 200 OK\nServer: old\n\n<p>hello</p>" + b"z" * 200),
        ("http://b/", "19970102030405", "text/html", b"HTTP/1.0 200 OK\r\nServer: old\r\n\r\n<p>hello</p>" + b"z" * 200),
        ("http://empty/", "19970102030405", "text/html", b"HTTP/1.0 304 Not Modified"), ("dns:a.org", "19970102030405", "text/dns", b"19970102030405\na.org. 10 IN A 1.2.3.4\n"),
        ("ftp://c/file", "never", "no-type", b"\x00\x01WARC/1.1\r\n\r\n"), ("http://d/", "19970102030405", "text/html", b""),
    ]

    def file(name):
        intro = f"1 0 elsewhere\n{fields}\n".encode()
        out = f"filedesc://{name} 0.0.0.0 19970101000000 text/plain {len(intro)}\n".encode() + intro
        for url, stamp, mime, block in blocks:
            out += f"\n{url} 1.2.3.4 {stamp} {mime} {len(block)}\n".encode() + block
        return out + b"\n"

    rows = [("a", gzip.compress(file("a") + file("b"))), ("c", file("c")), ("none", None)]
    warcs = warc.convert(spark.createDataFrame([(n, bytearray(c) if c else None) for n, c in rows], "archive string, content binary")).collect()
    found = [x for w in warcs for x in warc.parse_warc(gzip.decompress(bytes(w.content))) if x[0]["WARC-Type"] != "warcinfo"]
    assert Counter((h["WARC-Target-URI"], h["WARC-Type"], h["Content-Type"], h["WARC-Date"], b) for h, b in found) == Counter(
        {
            ("http://a/x y", "response", "application/http; msgtype=response", "1997-01-02T03:04:00Z", blocks[0][3]): 3,
            ("http://b/", "response", "application/http; msgtype=response", "1997-01-02T03:04:05Z", blocks[1][3]): 3,
            ("http://empty/", "response", "application/http; msgtype=response", "1997-01-02T03:04:05Z", blocks[2][3]): 3,
            ("dns:a.org", "response", "text/dns", "1997-01-02T03:04:05Z", blocks[3][3]): 3,
            ("ftp://c/file", "resource", "application/octet-stream", "1970-01-01T00:00:00Z", blocks[4][3]): 3,
            ("http://d/", "resource", "text/html", "1997-01-02T03:04:05Z", b""): 3,
        }
    )
    back = warc.read(spark.createDataFrame([(w.archive, w.content) for w in warcs], "archive string, content binary")).collect()
    assert Counter(r.payload_bytes for r in back) == Counter({212: 6, 0: 6, len(blocks[3][3]): 3, len(blocks[4][3]): 3}) and all(r.page_id is None for r in back)


def test_damaged_archives_are_rejected_alone(spark):
    rows = [(k, f"http://x/{k}", b"body %d " % k * 30) for k in range(6)]
    parts = warc.arc_file("n.arc", 1, rows)
    cut_off = b"".join(parts)[:-40]
    no_length = b"".join(parts).replace(b" %d\nHTTP" % len(parts[3][parts[3].index(b"\n") + 1 : -1]), b" x\nHTTP", 1)
    members = [warc.member(p) for p in parts]
    members[2] = members[2][:30] + b"\xff" * 8 + members[2][38:]
    files = {
        "good": b"".join(parts), "cut": cut_off, "length": no_length, "member": b"".join(members), "short": b"".join(map(warc.member, parts))[:-9],
        "version": b"".join(parts).replace(b"1 0 curator", b"9 0 \xff\xfe ator", 1), "noise": b"\x00\xff nothing", "none": None,
    }
    arcs = spark.createDataFrame([(n, bytearray(c) if c else None) for n, c in files.items()], "archive string, content binary")
    found = Counter(r.page_id for r in warc.records(arcs, False).collect())
    # good, cut, length, member, short: five files, of which each damaged one lacks one record
    assert sum(found.values()) == 6 + 5 + 5 + 5 + 5 and found[1] == 4 and found[5] == 3
    bad = warc.rejects(arcs).collect()
    assert {r.archive for r in bad} == {"cut", "length", "member", "short", "version", "noise"} and all(r.reason and r.place >= 0 for r in bad)
    with pytest.raises(Exception, match="length"):
        warc.records(arcs.filter("archive = 'length'"), False, strict=True).count()

    made = warc.convert(arcs.filter("archive = 'good'"))
    whole = b"".join(warc.content_of(bytes(r.content)) for r in made.collect())
    damaged = whole.replace(b"body 3 body 3", b"body 3 body X", 1).replace(b"Content-Length: ", b"Content-Lengte: ", 2)
    warcs = spark.createDataFrame([("w", bytearray(damaged))], "archive string, content binary")
    assert warc.read(warcs).count() < 6 == warc.read(made, strict=True).count()
    assert warc.read(warcs).count() + warc.rejects(warcs).count() == 7  # six records and the first, which says what the file is


def test_members_of_any_size_are_read():
    rng = np.random.default_rng(2)
    parts = [rng.bytes(n) for n in (0, 1, 8_192, 100_000)] * 3
    assert warc.content_of(b"".join(map(warc.member, parts)) + b"\0" * 9) == b"".join(parts)
    assert warc.content_of(b"plain") == b"plain" and warc.content_of(None) == b""
    with pytest.raises(ValueError):
        warc.content_of(warc.member(parts[3])[:-3])


def test_records_are_gzip_members(spark):
    import zlib as z

    pages = spark.createDataFrame([(i, "u", "text " * 40) for i in range(5)], "page_id bigint, url string, html string")
    for w in [*warc.to_arc(pages.coalesce(1)).collect(), *warc.convert(warc.to_arc(pages.coalesce(1))).collect()]:
        members, data = 0, bytes(w.content)
        while data:
            one = z.decompressobj(31)
            one.decompress(data)
            members, data = members + 1, one.unused_data
        assert members == 6


@settings(max_examples=50, deadline=None)
@given(st.integers(-(2**63), 2**63 - 1), st.binary(min_size=1, max_size=8))
def test_record_ids_hold_page_ids(key, body):
    name = warc.record_id(key, hashlib.sha256(body).hexdigest())
    assert warc.id_of(name) == key and re.fullmatch(r"urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-8[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", name)


# BPE -----------------------------------------------------------------------------------------------


def test_bpe_equals_the_tokenizers_library(spark, odd_docs):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.codec(path)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(250).collect()] + [r.text or "" for r in odd_docs.collect()]
    texts += ["İSTANBUL ΣΑΣ", "é ẋ́ ̂", "<|endoftext|>HI<|startoftext|> a", "a\x1cb \x1d c\x85d\xa0e", "I'll we've 'S x's", "漢字 🙂 12,345½", "Å Ω ﬁ Ǆ", "a​b‍c"]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        data = own.encode(text)
        assert np.frombuffer(data, "<u4").tolist() == ids
        assert library.decode(ids, skip_special_tokens=False) == own.decode(ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=40), st.integers(0, 5))
def test_segment_tree_merges_like_a_scan(symbols, seed):
    rng = np.random.default_rng(seed)
    pairs = {}
    for rank in range(20):
        pair = (int(rng.integers(0, 10)), int(rng.integers(0, 10)))
        pairs.setdefault(pair, (rank, 5 + rank % 8))
    want = list(symbols)
    while True:
        ranks = [(pairs[p][0], i) for i, p in enumerate(zip(want, want[1:], strict=False)) if p in pairs]
        if not ranks:
            break
        i = min(ranks)[1]
        want[i : i + 2] = [pairs[want[i], want[i + 1]][1]]
    assert bpe.merge(list(symbols), pairs) == want


def test_bpe_columns(spark, odd_docs, no_docs):
    path = vocabulary("word_bpe_49k.json")
    out = bpe.decode(bpe.encode(odd_docs, path), path)
    assert out.columns == [*odd_docs.columns, "encoded", "decoded"]
    digests = {(r.text, r.digest.n_tokens, r.digest.ids_sha256) for r in bpe.digest(odd_docs, path).collect()}
    for r in out.collect():
        ids = np.array(r.encoded, "<u4").tobytes()
        assert (r.text, len(r.encoded), hashlib.sha256(ids).hexdigest()) in digests
    assert bpe.digest(no_docs, path).count() == 0


def test_comments_and_end_tags_close_as_html_says():
    def texts(html):
        return [b.text for b in html_extract.leaf_blocks(html)]

    for mark in ("<!-->", "<!--->", "<!---->", "<!-- a > b --!>", "<!-- a -- > -->", "<!-- - -->", "<!doctype html>", "<?xml?>", "<!>"):
        assert texts(f"<p>one</p>{mark}<p>two</p>") == ["one", "two"], mark
    for end in ("</script>", "</script >", "</script foo>", "</SCRIPT/>", '</script a="b">', "</script\n>"):
        assert texts(f"<p>one</p><script>if (a<b) x('</scripty>')</script-x>{end}<p>two</p>") == ["one", "two"], end
    assert texts("<p>one</p><!-- never closed <p>two</p>") == ["one"]
    assert texts("<p>one</p>" + "<script>" + "</script " * 100_000) == ["one"]


# Licenses ------------------------------------------------------------------------------------------


def test_licenses_match_brute_force(spark, odd_docs, no_docs):
    rng = np.random.default_rng(3)
    noise = [" ".join(rng.choice(["river", "stone", "cloud", "the", "license", "software", "this"], 60)) for _ in range(len(licenses.TEMPLATES) + 1)]
    texts = []
    templates = licenses.TEMPLATES | licenses.whole_texts()
    noise += noise[: len(templates) + 1 - len(noise)]
    for k, (_, body) in enumerate(templates.items()):
        words = body.split()
        texts += [f"{noise[k]} {body} {noise[k + 1]}", f"{noise[k]}\n{body.upper()}\n{noise[k]} {body}"]
        if len(words) > 30:
            texts.append(f"{noise[k]} {' '.join(words[: len(words) // 2] + ['zzz'] + words[len(words) // 2 :])} {noise[k]}")
            texts.append(f"{noise[k]} {' '.join(words[: len(words) // 2])} {noise[k]}")
    texts += noise

    def parts(text, size):
        words = re.findall("[0-9a-z\x80-\U0010ffff]+", text.lower())
        return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}

    def holds(text, body):
        size = min(5, len(re.findall("[0-9A-Za-z]+", body)))
        own = parts(body, size)
        return len(own & parts(text, size)) >= 0.8 * len(own)

    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for row in licenses.scan(frame).collect():
        want = sorted(name for name, body in templates.items() if holds(row.text, body))
        assert row.licenses.licenses == ",".join(want)
    odd = licenses.scan(odd_docs, into="found")
    assert odd.count() == odd_docs.count() and all(r.found.n_matches == 0 for r in odd.collect())
    assert licenses.scan(no_docs).count() == 0


def test_licenses_find_copies_with_inserted_words_at_every_alignment():
    templates = {t.name: t for t in licenses.default_templates()}
    for name in ("MIT", "GPL-3.0", "BSD-3-Clause"):
        t, words = templates[name], licenses.TEMPLATES[name].split()
        texts = []
        for inserted in (60, 80, 2000):
            for lead in range(0, 200, 5):
                at = len(words) // 2 if lead % 2 else len(words) // 8 + lead % 50
                texts.append(" ".join(["stone"] * lead + words[:at] + ["river"] * inserted + words[at:] + ["cloud"] * 50))
        texts.append(" ".join(["stone"] * 30 + [w for i, x in enumerate(words) for w in ([x] if i % 25 else [x, *["river"] * 200])]))
        texts.append(" ".join(words[: len(words) // 2] + ["river"] * 400))
        texts.append(" ".join(words + words + ["river"] * 900 + words))
        data = [x.lower().encode() for x in texts]
        offsets = np.cumsum([0, *map(len, data)])
        found = licenses.scan_slice(np.frombuffer(b"".join(data), np.uint8), offsets, [t])
        for text, matches in zip(data, found, strict=True):
            part = len(t.words & set(licenses.shingles(licenses._WORD.findall(text), t.size))) / len(t.words)
            assert bool(matches) == (part >= 0.8)
            if matches:
                assert max(m[1] for m in matches) == part
        assert len(found[-1]) == 3 and all(len(m) == 1 for m in found[:-3]) and not found[-2]


def _slice(texts):
    data = [x.lower().encode() for x in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def test_license_windows_retrieve_damaged_copies_at_every_alignment():
    """Copies of whole texts and notices with up to a fifth of the shingles lost, contiguous or in pieces, at many places: all are found."""
    rng = np.random.default_rng(11)
    every = licenses.default_templates()
    bodies = licenses.TEMPLATES | licenses.whole_texts()
    assert all(licenses.miss_bound(len(t.hashes)) < 4e-7 for t in every)
    wanted = matched = 0
    for t in every:
        words = licenses._WORD.findall(bodies[t.name].lower().encode())
        texts = []
        for lead in range(0, 40, 4 if t.n < 400 else 20):
            copy = list(words)
            for at in sorted(rng.integers(0, len(copy), int(rng.integers(0, 1 + t.n // 24))).tolist(), reverse=True):
                copy[at] = b"zz%d" % at
            for at in sorted(rng.integers(0, len(copy), t.n // 60).tolist(), reverse=True):
                copy[at:at] = [b"river%d" % k for k in rng.integers(0, 10**6, int(rng.integers(1, 4 * t.n + 2))).tolist()]
            noise = [b"stone%d" % k for k in rng.integers(0, 10**6, lead).tolist()]
            texts.append(b" ".join(noise + copy + noise).decode())
        data, offsets = _slice(texts)
        for text, matches in zip(texts, licenses.scan_slice(data, offsets, [t]), strict=True):
            part = len(t.words & set(licenses.shingles(licenses._WORD.findall(text.encode()), t.size))) / len(t.words)
            wanted += part >= 0.8
            matched += bool(matches)
            assert bool(matches) == (part >= 0.8), (t.name, part)
    assert wanted == matched > 100


def test_licenses_are_retrieved_by_bands_only(monkeypatch):
    mit = [t for t in licenses.default_templates() if t.name == "MIT"]
    data, offsets = _slice([licenses.TEMPLATES["MIT"], "river stone cloud " * 50])
    assert [len(x) for x in licenses.scan_slice(data, offsets, mit)] == [1, 0]
    plain = licenses.permuted
    monkeypatch.setattr(licenses, "permuted", lambda hashes, band: plain(hashes ^ np.uint64(1), band))
    assert licenses.scan_slice(data, offsets, mit) == [[], []]


def test_license_windows_are_what_a_plain_loop_makes_of_them():
    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 1 << 63, 301).astype(np.uint64)
    texts = np.sort(rng.integers(0, 9, len(hashes)))
    templates = []
    for n in (1, 2, 3, 7, 16, 90, 700):
        own = np.unique(np.concatenate([rng.choice(hashes, n // 2 + 1), rng.integers(0, 1 << 63, n).astype(np.uint64)])[:n])
        templates.append(licenses.Template(str(n), 5, n, frozenset(), Counter(), own, np.array([licenses.permuted(own, b).min() for b in range(licenses.BANDS)], np.uint32)))
    want = np.zeros((9, len(templates)), bool)
    for i, t in enumerate(templates):
        step = t.window // 2
        for at in range(0, len(hashes), step):
            for band in range(licenses.BANDS):
                if licenses.permuted(hashes[at : at + t.window], band).min() == t.bands[band]:
                    want[texts[at] : texts[min(at + t.window, len(hashes)) - 1] + 1, i] = True
    assert (licenses.retrieve(hashes, texts, 9, templates) == want).all() and want.any()


def test_word_hashes_depend_on_bytes_only():
    data = np.frombuffer(b"ab cd ab xab abx", np.uint8)
    words = textbatch.Words(data, np.array([0, 5, len(data)]))
    hashes = words.hashes.tolist()
    assert hashes[0] == hashes[2] and len(set(hashes)) == 4
    assert words.texts.tolist() == [0, 0, 1, 1, 1]
