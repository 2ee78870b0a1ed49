"""Landing, zones, homogenising, media, vectors and collections on small fixtures."""

from __future__ import annotations

import io
import os
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.functions import encoders as E
from tarn.functions import keys as K
from tarn.functions import vectors as VE
from tarn.operators import collections as CO
from tarn.operators import embeddings as EM
from tarn.operators import homogenize as H
from tarn.operators import landing as L
from tarn.operators import media as M
from tarn.operators.images import area_weights, image_standardize, standardize_pixels
from tarn.operators.ordinal import ordinal, running_total
from tarn.plans import exploitation as X
from tarn.plans import zones as Z
from tarn.sources import tables as S
from tarn.sources.snapshots import Snapshots
from tarn.streaming.drain import file_stream, object_stream, promote_landing_stream


def column(spark, rule, inputs):
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("x"))).collect()]


KEYS = ["a/b.jpg", "noext", ".hidden", "a.b.JPG", "x.tar.gz", "d.ir/file", "a/.b.c", "a..b", "..b", "end."]


def test_extensions_follow_splitext(spark):
    got = column(spark, lambda k: K.replace_extension(k, ".png"), KEYS)
    assert got == [os.path.splitext(k)[0] + ".png" for k in KEYS]
    assert column(spark, K.extension, KEYS) == [os.path.splitext(k)[1].lower() for k in KEYS]
    urls = ["http://h/a.jpg?t=1.2", "http://h/a.jpg?t=1", "a.b.c", "none"]
    assert column(spark, K.link_extension, urls) == [u.split(".")[-1].split("?")[0] for u in urls]


def test_ordinal_is_dense_and_ordered(spark):
    rows = [(i % 3 if i % 4 else 9, f"k{(i * 7919) % 1000:04d}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "g int, k string, v int").repartition(7)
    got = {r["k"]: r["ordinal"] for r in ordinal(df, ["k"]).collect()}
    assert got == {k: n for n, k in enumerate(sorted(r[1] for r in rows), start=1)}
    inside = ordinal(df, ["k"], "n", within=["g"]).collect()
    for group in {r[0] for r in rows}:
        mine = sorted(r["k"] for r in inside if r["g"] == group)
        assert {r["k"]: r["n"] for r in inside if r["g"] == group} == {k: n for n, k in enumerate(mine, start=1)}
    totals = running_total(df, ["k"], "v", "before").orderBy("k").collect()
    so_far = 0
    for row in totals:
        assert row["before"] == so_far
        so_far += row["v"]


def test_ordinal_numbers_repeated_keys_apart(spark):
    rows = [(i % 5, f"v{i}") for i in range(40)] + [(None, "n")] * 3
    df = spark.createDataFrame(rows, "k int, v string").repartition(5)
    got = ordinal(df, ["k"]).collect()
    assert sorted(r["ordinal"] for r in got) == list(range(1, 44))
    assert [r["k"] for r in sorted(got, key=lambda r: r["ordinal"])] == [None] * 3 + [i for i in range(5) for _ in range(8)]
    inside = ordinal(df, ["v"], "n", ["k"], "size").collect()
    assert len(inside) == 43 and {r["size"] for r in inside if r["k"] == 1} == {8}
    assert sorted(r["n"] for r in inside if r["k"] is None) == [1, 2, 3]


def test_ordinal_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, "a"), ("x", "b"), ("y", "c")], "k string, v string")
    assert {r["v"]: r["ordinal"] for r in ordinal(df, ["k"]).collect()} == {"a": 1, "b": 2, "c": 3}


def test_text_objects_number_before_skipping(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None), (4, "é")], "n int, text string")
    got = L.text_objects(df, ["n"]).orderBy("key").collect()
    assert [(r["key"], r["size"]) for r in got] == [("temporal-landing/text_1.txt", 1), ("temporal-landing/text_4.txt", 2)]


def test_records_accept_python_literals(spark):
    cells = [
        "{'id': 1, 'image': 'http://h/a.jpg'}|{'id': None, 'image': \"it's.png\", 'ok': True}",
        "{'image': 'None, True'}|{broken",
        "",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, shots string")
    got = L.explode_records(df, "shots").orderBy("i", "record_no").collect()
    assert [r["image"] for r in got] == ["http://h/a.jpg", "it's.png", "None, True", None]


def test_zero_size_and_placeholders(spark):
    rows = [("b", "dir/", 0), ("b", "empty.png", 0), ("b", "a.png", 5)]
    df = spark.createDataFrame(rows, "bucket string, key string, size long")
    assert {r["key"] for r in L.drop_placeholders(df).collect()} == {"empty.png", "a.png"}
    assert {r["key"] for r in L.drop_placeholders(df, True).collect()} == {"a.png"}
    assert {(r["key"], r["purge"]) for r in M.purge_zero_size(df).collect()} == {("empty.png", True), ("a.png", False)}


def test_replication_last_source_key_wins(spark):
    schema = "bucket string, key string, size long"
    source = spark.createDataFrame([("a", "px", 1), ("a", "p/x", 2), ("a", "q/y", 3)], schema)
    dest = spark.createDataFrame([("b", "x", 9), ("b", "z", 8)], schema)
    got = {(r["key"], r["size"]) for r in L.replicate_zone(source, dest, "b", "p").collect()}
    assert got == {("x", 1), ("z", 8)}


def zipped(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, body in members:
            archive.writestr(name, body)
    return bytearray(buffer.getvalue())


def test_archives(spark):
    bodies = [
        ("b.zip", zipped([("2.html", "<p>&nbsp;two &#8212; &amp;lt;</p>"), ("1.XHTML", "<b>one</b>"), ("x.txt", "no")])),
        ("e.epub", zipped([])),
        ("bad.zip", bytearray(b"no archive")),
    ]
    df = spark.createDataFrame(bodies, "key string, content binary")
    got = {r["key"]: (r["text"], r["error"] is None) for r in H.archive_members_to_text(df).collect()}
    assert got == {"b.zip": ("one\n\ntwo — &lt;", True), "e.epub": ("", True), "bad.zip": ("", False)}


def test_transcoding(spark):
    text = "Füße €"
    cases = {
        "ascii": b"plain",
        "utf-8": text.encode(),
        "utf-8-sig": text.encode("utf-8-sig"),
        "utf-16": text.encode("utf-16"),
        "iso-8859-1": "Füße".encode("latin-1"),
        "empty": b"",
    }
    damaged = spark.createDataFrame([("x", bytearray(text.encode("utf-16") + b"\xd8"))], "key string, content binary")
    assert H.transcode_utf8(damaged).first()["text"] == text
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in cases.items()], "key string, content binary")
    got = {r["key"]: (r["encoding"], r["text"]) for r in H.transcode_utf8(df).collect()}
    want = {"ascii": "plain", "iso-8859-1": "Füße", "empty": ""}
    assert got == {k: (k, want.get(k, text)) for k in cases}


def test_extract_texts_by_format(spark):
    bodies = [
        ("t/a.TXT", b"\xef\xbb\xbfplain"),
        ("t/b.html", b"<p>page</p>"),
        ("t/c.md", b"![[x]] words"),
        ("t/d.rtf", b"{\\rtf1 head} rich"),
        ("t/e.docx", b"PK"),
        ("t/f.zip", bytes(zipped([("i.html", "<p>in</p>")]))),
    ]
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in bodies], "key string, content binary")
    got = {r["source_key"]: (r["key"], r["text"], r["outcome"]) for r in H.extract_texts(df).collect()}
    assert got["t/a.TXT"] == ("t/a.TXT", "plain", "replaced")
    assert got["t/b.html"] == ("t/b.txt", "page", "replaced")
    assert got["t/c.md"] == ("t/c.txt", "words", "replaced")
    assert got["t/d.rtf"][0] == "t/d.txt" and "rich" in got["t/d.rtf"][1]
    assert got["t/e.docx"] == ("t/e.docx", None, "unsupported")
    assert got["t/f.zip"] == ("t/f.txt", "in", "replaced")


def png(width, height, colour, pixels):
    def part(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    channels = {0: 1, 2: 3, 6: 4}[colour]
    lines = b"".join(
        b"\0" + bytes(pixels[y * width * channels : (y + 1) * width * channels]) for y in range(height)
    )
    head = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")


def test_images_from_files(spark, tmp_path):
    folder = tmp_path / "images"
    folder.mkdir()
    random = np.random.default_rng(1)
    files = {"rgb.png": (2, 6, 4), "grey.png": (0, 5, 3), "rgba.png": (6, 4, 4)}
    for name, (colour, w, h) in files.items():
        n = w * h * {0: 1, 2: 3, 6: 4}[colour]
        (folder / name).write_bytes(png(w, h, colour, random.integers(0, 256, n, dtype=np.uint8).tobytes()))
    (folder / "broken.png").write_bytes(b"not an image")
    (folder / "zero.png").write_bytes(b"")
    bodies = S.read_bodies(spark, str(folder))
    header = {r["file_name"]: (r["width"], r["height"], r["mode"], r["channels"]) for r in M.image_profile(bodies).collect()}
    assert header["rgb.png"] == (6, 4, "RGB", 3) and header["grey.png"] == (5, 3, "L", 1)
    assert header["rgba.png"] == (4, 4, "RGBA", 4) and header["broken.png"] == (None, None, None, None)
    images = S.read_images(spark, str(folder))
    meta = S.image_metadata(images, S.list_files(spark, str(folder), "trusted-zone"), str(folder))
    decoded = {r["file_name"]: (r["width"], r["height"], r["mode"], r["channels"]) for r in M.media_profile(meta).collect()}
    assert decoded == {name: header[name] for name in files}
    out = image_standardize(images, (8, 8)).collect()
    assert len(out) == 3 and all(len(r["data"]) == 192 and r["nChannels"] == 3 for r in out)


def test_standardize_keeps_flat_colours():
    bgr = np.tile(np.array([10, 200, 33], dtype=np.uint8), 7 * 5)
    for target in ((16, 9), (3, 2)):
        got = standardize_pixels(bgr.tobytes(), 7, 5, 3, target)
        assert got.shape == (target[1], target[0], 3) and (got == [33, 200, 10]).all()
    ramp = np.arange(16, dtype=np.uint8).reshape(4, 4)
    same = standardize_pixels(ramp.tobytes(), 4, 4, 1, (4, 4))
    assert (same[:, :, 0] == ramp).all()


def test_area_weights():
    assert (area_weights(4, 2) == [[0.5, 0.5, 0, 0], [0, 0, 0.5, 0.5]]).all()
    assert area_weights(3, 2).tolist() == [pytest.approx([2 / 3, 1 / 3, 0]), pytest.approx([0, 1 / 3, 2 / 3])]
    assert (area_weights(2, 4) @ [1.0, 5.0]).tolist() == [1.0, 1.0, 5.0, 5.0]


def test_quantiles_and_describe(spark):
    values = [1.0] * 40 + [2.0, 3.5, 7.0, 9.0, None]
    df = spark.createDataFrame([(v, "a" if i % 3 else "b") for i, v in enumerate(values)], "x double, s string")
    clean = [v for v in values if v is not None]
    got = {r["level"]: r["value"] for r in M.quantiles(df, ["x"], (0.0, 0.25, 0.9, 0.95, 1.0)).collect()}
    for level, value in got.items():
        assert value == pytest.approx(np.quantile(clean, level))
    stats = {(r["column"], r["stat"]): r["value"] for r in M.describe_all(df, ["s"], ["x"]).collect()}
    assert stats["s", "top"] == "a" and stats["s", "unique"] == "2" and stats["x", "count"] == "44.000000"


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "x double")
    got = [r["n"] for r in M.histogram(df, "x", 5).orderBy("bin").collect()]
    assert got == np.histogram(np.arange(11.0), bins=5)[0].tolist()
    one = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert sum(r["n"] for r in M.histogram(one, "x", 5).collect()) == 2


@pytest.mark.parametrize("total", [1, 15, 16, 17, 50, 160])
def test_frame_sample(spark, total):
    frames = spark.createDataFrame([("v", i) for i in range(total)], "video_id string, frame_no long")
    step = max(1, total // 16)
    want = list(range(0, total, step))[:16]
    assert sorted(r["frame_no"] for r in M.frame_sample(frames).collect()) == want


def test_frame_sample_unknown_total_and_unreadable(spark):
    rows = [("v", i, None if i == 3 else bytearray(b"x"), None) for i in range(40)]
    frames = spark.createDataFrame(rows, "video_id string, frame_no long, payload binary, n long")
    got = sorted(r["frame_no"] for r in M.frame_sample(frames, total="n").collect())
    assert got == [i for i in range(16) if i != 3]


@pytest.mark.parametrize("fps,skip", [(15.0, 1), (30.0, 1), (45.0, 2), (60.0, 2), (75.0, 2), (0.0, None)])
def test_frame_decimate(spark, fps, skip):
    frames = spark.createDataFrame([("v", i, fps) for i in range(1, 11)], "video_id string, frame_no long, fps double")
    got = sorted(r["frame_no"] for r in M.frame_decimate(frames).collect())
    assert got == ([] if skip is None else [i for i in range(1, 11) if i % skip == 0])


def test_vectors(spark):
    df = spark.createDataFrame([("z", [0.0, 0.0]), ("a", [3.0, 4.0])], "id string, embedding array<float>")
    got = {r["id"]: list(r["embedding"]) for r in EM.l2_normalize(df).collect()}
    assert got == {"z": [0.0, 0.0], "a": [0.6, 0.8]}
    weights, bias = E.projection_weights(2, 5, seed=3)
    again, _ = E.projection_weights(2, 5, seed=3)
    assert (weights == again).all()
    wide = {r["id"]: np.array(r["embedding"]) for r in EM.project_linear(df, weights, bias).collect()}
    want = weights @ np.array([3.0, 4.0]) + bias
    assert wide["a"] == pytest.approx(want / np.linalg.norm(want), abs=1e-6)
    apart = df.withColumn("o", F.col("embedding"))
    assert [r[0] for r in apart.select(VE.distance(F.col("embedding"), F.col("o"), "cosine")).collect()] == [None, 0.0]
    assert [r[0] for r in apart.select(VE.distance(F.col("embedding"), F.col("o"))).collect()] == [0.0, 0.0]


def test_paragraph_embedding_edges(spark):
    docs = spark.createDataFrame([("none", "  "), ("one", "a b"), ("two", "a b\n\nc c")], "key string, text string")
    encode = E.hash_encoder(16)()
    got = {r["key"]: np.array(r["embedding"]) for r in EM.embed_paragraphs(docs, E.hash_encoder(16)).collect()}
    assert (got["none"] == 0).all() and len(got["none"]) == 16
    assert got["one"] == pytest.approx(encode(["a b"])[0], abs=1e-6)
    mean = encode(["a b", "c c"]).mean(axis=0)
    assert got["two"] == pytest.approx(mean / np.linalg.norm(mean), abs=1e-6)


def test_video_ids_count_unreadable_videos(spark):
    objects = spark.createDataFrame([("v/b",), ("v/a",), ("v/c",)], "key string")
    ids = EM.assign_ids(objects, "vid")
    assert {r["key"]: r["id"] for r in ids.collect()} == {"v/a": "vid_1", "v/b": "vid_2", "v/c": "vid_3"}


def test_collections(spark, tmp_path):
    store = CO.CollectionStore(spark, str(tmp_path / "store"))
    schema = "id string, document string, embedding array<float>"
    rows = spark.createDataFrame([("1", "z/a.png", [1.0, 0.0]), ("1", "z/b.png", [0.0, 1.0]), ("2", "z/c.txt", [0.0, 1.0])], schema)
    assert store.get_or_create("images").count() == 0
    store.add("images", rows)
    store.add("images", rows)
    kept = {r["id"]: (r["document"], r["modality"]) for r in store.get_or_create("images").collect()}
    assert kept == {"1": ("z/a.png", "image"), "2": ("z/c.txt", "text")}
    store.upsert("images", spark.createDataFrame([("1", "z/new.mp4", [0.5, 0.5])], schema))
    assert {r["document"] for r in store.get_or_create("images").collect()} == {"z/new.mp4", "z/c.txt"}
    store.merge("all", "images")
    assert store.names() == ["all", "images"] and store.peek("all", 1).count() == 1
    with pytest.raises(Exception, match="width 2, found width 1"):
        store.add("images", spark.createDataFrame([("9", "z/x.png", [1.0])], schema))
    store.drop("images")
    assert store.names() == ["all"]


def test_text_zone_end_to_end(spark, tmp_path):
    zone = Snapshots(spark, str(tmp_path / "zone"))
    page = "<p>" + "This is the first page of the game and it is long enough. " * 20 + "</p><p>Café&hellip;</p>"
    rows = [
        ("landing-zone", "temporal-landing/", 0, "", bytearray()),
        ("landing-zone", "temporal-landing/a.html", len(page), "text/html", bytearray(page.encode())),
        ("landing-zone", "temporal-landing/b.txt", 4, "text/plain", bytearray(b"tiny")),
        ("landing-zone", "temporal-landing/c.jpg", 4, "image/jpeg", bytearray(b"\xff\xd8")),
        ("landing-zone", "temporal-landing/d.bin", 4, "application/x", bytearray(b"1234")),
    ]
    zone.write("temporal", spark.createDataFrame(rows, "bucket string, key string, size long, content_type string, content binary"))
    moved = Z.drain_landing(zone, 5)
    assert {r["category"] for r in moved.collect()} == {"texts", "images", "quarantine"}
    assert [r["key"] for r in zone.read("temporal").collect()] == ["temporal-landing/"]
    assert Z.drain_landing(zone, 6).count() == 4
    assert zone.read("persistent").count() == 4
    assert Z.format_texts(zone).count() == 2
    trusted = Z.trust_texts(zone).collect()
    assert len(trusted) == 1 and trusted[0]["key"] == "texts/text_5.txt" and trusted[0]["text"].isascii()
    assert zone.read("text_profiles").count() == 2


def test_exploitation_end_to_end(spark, tmp_path):
    store = CO.CollectionStore(spark, str(tmp_path / "store"))
    texts = spark.createDataFrame(
        [("texts/b.txt", "red robot war"), ("texts/a.txt", "quiet farm life\n\ncows"), ("texts/c.txt", "")], "key string, text string"
    )
    X.store_texts(store, "texts", texts, E.hash_encoder(16))
    images = spark.createDataFrame([("images/a.png", "red robot"), ("images/b.png", "farm")], "key string, payload string")
    X.store_images(store, "images", images, E.hash_encoder(16))
    videos = spark.createDataFrame([("videos/a.mp4",), ("videos/b.mp4",)], "key string")
    frames = spark.createDataFrame([("videos/b.mp4", i, "red war robot") for i in range(40)], "video_id string, frame_no long, payload string")
    X.store_videos(store, "videos", videos, frames, E.hash_encoder(24))
    ids = {r["document"]: r["id"] for n in ("texts", "images", "videos") for r in store.get_or_create(n).collect()}
    assert ids["trusted-zone/texts/b.txt"] == "text_2" and ids["trusted-zone/videos/b.mp4"] == "vid_2"
    assert "trusted-zone/videos/a.mp4" not in ids
    both = X.merge_collections(store, "texts_images", ["texts", "images"])
    assert both.count() == 5
    asked = EM.encode_batch(spark.createDataFrame([("q", "red robot war")], "query_id string, text string"), E.hash_encoder(16), "text")
    hits = X.search(store, "texts_images", asked, texts, k=1).orderBy("rank").collect()
    assert [(r["id"], r["text"]) for r in hits] == [("text_2", "red robot war"), ("img_1", None)]
    wide = X.merge_collections(store, "all", ["texts", "images", "videos"], 24)
    assert {len(r["embedding"]) for r in wide.collect()} == {24} and wide.count() == 6
    weights, bias = X.stored_projection(store, 16, 24)
    query = EM.project_linear(asked, weights, bias)
    best = X.search(store, "all", query, k=1, videos=True).orderBy("rank").first()
    assert best["id"] == "text_2" and best["distance"] == pytest.approx(0, abs=1e-9)
    assert store.names() == ["all", "images", "texts", "texts_images", "videos"]


def test_numbers_run_on_over_batches(spark, tmp_path):
    store = CO.CollectionStore(spark, str(tmp_path / "store"))
    batch = lambda *names: spark.createDataFrame([(f"texts/{n}.txt", f"words of {n}") for n in names], "key string, text string")
    X.store_texts(store, "texts", batch("b", "a"), E.hash_encoder(16))
    X.store_texts(store, "texts", batch("d", "c"), E.hash_encoder(16))
    want = {f"trusted-zone/texts/{n}.txt": f"text_{i}" for i, n in enumerate("abcd", 1)}
    assert {r["document"]: r["id"] for r in store.get_or_create("texts").collect()} == want
    X.store_texts(store, "texts", batch("c", "a"), E.hash_encoder(16))
    assert store.get_or_create("texts").count() == 4 and store.ledger.mark("text") == 4
    # A batch that was numbered but not stored is stored with its numbers when it comes again.
    store.ledger.extend(batch("f", "e").select("key"), "text").count()
    X.store_texts(store, "texts", batch("0", "e", "f").unionByName(batch("e")), E.hash_encoder(16))
    want |= {"trusted-zone/texts/e.txt": "text_5", "trusted-zone/texts/f.txt": "text_6", "trusted-zone/texts/0.txt": "text_7"}
    assert {r["document"]: r["id"] for r in store.get_or_create("texts").collect()} == want
    assert store.names() == ["texts"] and store.ledger.mark("img") == 0
    odd = store.ledger.extend(spark.createDataFrame([(None,), ("x",), ("x",)], "name string"), "img", "name")
    assert sorted((r["name"] or "", r["id"] or "") for r in odd.collect()) == [("", ""), ("x", "img_1"), ("x", "img_1")]


def test_raw_inputs_are_asked_as_objects_were_stored(spark, tmp_path):
    store = CO.CollectionStore(spark, str(tmp_path / "store"))
    texts = spark.createDataFrame([("texts/a.txt", "red robot war"), ("texts/b.txt", "quiet farm " + "cow " * 600)], "key string, text string")
    X.store_texts(store, "texts", texts, E.hash_encoder(16))
    asked = spark.createDataFrame([("q1", "robot war red"), ("q2", "quiet farm " + "cow " * 900)], "query_id string, text string")
    best = {r["query_id"]: (r["id"], r["distance"]) for r in X.ask(store, "texts", asked, E.hash_encoder(16), k=1).collect()}
    assert best["q1"][0] == "text_1" and best["q2"][0] == "text_2" and best["q2"][1] == pytest.approx(0, abs=1e-9)
    wide = X.merge_collections(store, "wide", ["texts"], 24)
    assert wide.count() == 2
    best = X.ask(store, "wide", asked, E.hash_encoder(16), k=1).filter("query_id = 'q1'").first()
    assert best["id"] == "text_1" and best["distance"] == pytest.approx(0, abs=1e-9)
    frames = spark.createDataFrame([("v", i, "red robot war") for i in range(20)], "query_id string, frame_no long, payload string")
    assert X.ask(store, "texts", frames, E.hash_encoder(16), "payload", k=1).first()["id"] == "text_1"


def test_small_numbers_keep_their_digits(spark):
    df = spark.createDataFrame([("a", 1e-9), ("b", 3e-9)], "s string, x double")
    stats = {(r["column"], r["stat"]): (r["value"], r["number"]) for r in M.describe_all(df, ["s"], ["x"]).collect()}
    assert stats["x", "mean"][1] == pytest.approx(2e-9, rel=1e-12) and float(stats["x", "max"][0]) == 3e-9
    assert stats["x", "25%"][1] == pytest.approx(1.5e-9) and stats["s", "top"] == ("a", None)


def test_payloads_and_words_stay_where_they_are(spark, tmp_path):
    rows = [(f"v{i % 3}", i // 3, f"payload {i}") for i in range(90)]
    path = str(tmp_path / "frames")
    spark.createDataFrame(rows, "video_id string, frame_no long, payload string").write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.frame_sample(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    texts = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "key long, text string")
    coded = EM.hash_encode(texts, 8)
    assert "Exchange" not in coded._jdf.queryExecution().executedPlan().toString()
    got = {r["key"]: r["embedding"] for r in coded.collect()}
    assert got[2] == got[3] == [0.0] * 8 and got[1] == pytest.approx(E.hash_encoder(8)()(["a b a"])[0], abs=1e-6)


def test_hot_groups(spark):
    """One key with most of the rows: positions, samples and means stay right."""
    n = 3000
    rows = [("hot" if i % 3 else f"v{i % 7}", i, [float(i), 1.0]) for i in range(n)]
    df = spark.createDataFrame(rows, "video_id string, k long, embedding array<double>").repartition(8)
    frames = M.number_frames(df, "k")
    hot = [r["frame_no"] for r in frames.filter("video_id = 'hot'").orderBy("k").collect()]
    assert hot == list(range(len(hot)))
    step = len(hot) // 16
    sample = sorted(r["frame_no"] for r in M.frame_sample(frames).filter("video_id = 'hot'").collect())
    assert sample == [step * i for i in range(16)]
    means = {r["video_id"]: r["embedding"][0] for r in EM.mean_pool(df, ["video_id"]).collect()}
    assert means["hot"] == pytest.approx(np.mean([i for i in range(n) if i % 3]))


def test_stream_promotes_each_file_once(spark, tmp_path):
    source, dest, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "bucket string, key string, size long, content_type string"

    def arrive(n):
        row = ("landing-zone", f"temporal-landing/{n}.txt", 3, "text/plain")
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = object_stream(spark, source, schema)
        promote_landing_stream(stream, dest, progress, 100).awaitTermination()
        return spark.read.parquet(dest).count()

    arrive("a")
    assert run() == 1
    assert run() == 1
    arrive("b")
    assert run() == 2


def test_binary_file_stream(spark, tmp_path):
    source = tmp_path / "files"
    source.mkdir()
    (source / "a.txt").write_bytes(b"hello")
    (source / "b.png").write_bytes(b"123")
    dest = str(tmp_path / "dest")
    promote_landing_stream(file_stream(spark, str(source)), dest, str(tmp_path / "p"), 7).awaitTermination()
    got = {(r["key"], r["category"], bytes(r["content"])) for r in spark.read.parquet(dest).collect()}
    assert got == {("temporal-landing/a.txt", "texts", b"hello"), ("temporal-landing/b.png", "images", b"123")}


STAGED = "bucket string, key string, size long, content_type string, content binary"


def staged(spark, *names):
    rows = [("landing-zone", f"temporal-landing/{n}.txt", 1, "text/plain", bytearray(n.encode())) for n in names]
    return spark.createDataFrame(rows, STAGED)


def test_a_drain_keeps_what_is_staged_meanwhile(spark, tmp_path, monkeypatch):
    zone = Snapshots(spark, str(tmp_path))
    zone.write("temporal", staged(spark, "a", "b"))
    whole = Snapshots.append

    def late(self, name, df, by=()):
        out = whole(self, name, df, by)
        if name == "persistent":
            whole(self, "temporal", staged(spark, "c"))
        return out

    monkeypatch.setattr(Snapshots, "append", late)
    assert Z.drain_landing(zone, 5).count() == 2
    monkeypatch.undo()
    assert [r["key"] for r in zone.read("temporal").collect()] == ["temporal-landing/c.txt"]
    assert sorted(r["key"][-5:] for r in Z.drain_landing(zone, 6).collect()) == ["a.txt", "b.txt", "c.txt"]
    assert zone.read("temporal").count() == 0


def test_a_drain_that_stopped_half_way_moves_nothing_twice(spark, tmp_path, monkeypatch):
    zone = Snapshots(spark, str(tmp_path))
    zone.write("temporal", staged(spark, "a", "b"))
    monkeypatch.setattr(Snapshots, "write", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    zone.spark.createDataFrame([(1,)], "x int").write.parquet(str(tmp_path / "unused"))
    with pytest.raises(OSError):
        Z.drain_landing(zone, 5)
    monkeypatch.undo()
    # The first move failed as a whole here; now stop between the two writes.
    plain = Snapshots.write
    monkeypatch.setattr(Snapshots, "write", lambda self, name, *a: plain(self, name, *a) if name == "persistent" else (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        Z.drain_landing(zone, 6)
    assert zone.read("persistent").count() == 2 and zone.read("temporal").count() == 2
    monkeypatch.undo()
    assert Z.drain_landing(zone, 7).count() == 2 and zone.read("temporal").count() == 0


def test_a_failed_addition_is_not_seen(spark, tmp_path):
    store = CO.CollectionStore(spark, str(tmp_path))
    row = lambda i: (f"i{i}", f"trusted-zone/texts/{i}.txt", [float(i), 1.0])
    schema = "id string, document string, embedding array<float>"
    before = store.add("c", spark.createDataFrame([row(0)], schema))
    bad = spark.createDataFrame([row(1), row(2)], schema).repartition(2).withColumn(
        "embedding", F.when(F.col("id") == "i2", F.raise_error(F.lit("broken")).cast("array<float>")).otherwise(F.col("embedding"))
    )
    with pytest.raises(Exception, match="broken"):
        store.add("c", bad)
    assert [r["id"] for r in store.get_or_create("c").collect()] == ["i0"]
    assert store.add("c", spark.createDataFrame([row(1)], schema)).count() == 2
    assert before.count() == 1


def test_streamed_files_are_keyed_below_the_root(spark, tmp_path):
    from tarn.streaming.drain import file_stream, promote_landing_stream

    for name in ("u/a.txt", "v/a.txt"):
        (tmp_path / "in" / name).parent.mkdir(parents=True)
        (tmp_path / "in" / name).write_text(name)
    stream = file_stream(spark, str(tmp_path / "in"))
    promote_landing_stream(stream, str(tmp_path / "out"), str(tmp_path / "mark"), 7).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out" / "batch=0")).collect()
    assert sorted((r["key"], bytes(r["content"]).decode()) for r in rows) == [
        ("temporal-landing/u/a.txt", "u/a.txt"),
        ("temporal-landing/v/a.txt", "v/a.txt"),
    ]
    assert len({r["dest_key"] for r in rows}) == 2
