"""Readers, writers and the corpus plan on files."""

import glob
import io
import math
import shutil
import struct
import wave

import pytest
from pyspark.sql import functions as F

from voxloom.operators.detect import trigram_profile
from voxloom.plans import corpus
from voxloom.sources import audio as U
from voxloom.sources import readers as R
from voxloom.sources import wavfiles
from voxloom.sources import writers as W


def test_scan_machines_falls_back(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        R.scan_merge_machines(spark, str(tmp_path))
    spark.range(3).write.parquet(str(tmp_path / "flat"))
    assert R.scan_merge_machines(spark, str(tmp_path / "flat")).count() == 3
    for machine in (0, 1):
        spark.range(machine, machine + 1).write.parquet(str(tmp_path / "many" / f"machine_{machine:02d}"))
    rows = R.scan_merge_machines(spark, str(tmp_path / "many")).collect()
    assert sorted(r["id"] for r in rows) == [0, 1] and all("machine_" in r["file"] for r in rows)


def test_shards_have_exact_sizes(spark, tmp_path):
    path = str(tmp_path / "shards")
    W.write_parquet_shards(spark.range(10), path, "id", 4)
    back = R.scan_parquet_shards(spark, path, with_file=True)
    sizes = [r["count"] for r in back.groupBy("shard").count().orderBy("shard").collect()]
    assert sizes == [3, 3, 2, 2]
    assert back.select("shard", "shard_file").distinct().count() == 4


def test_shards_may_be_folders(spark, tmp_path):
    spark.range(3).repartition(2).write.parquet(str(tmp_path / "rows.parquet"))
    spark.range(50, 60).write.parquet(str(tmp_path / "other.parquet"))
    back = R.scan_parquet_shards(spark, str(tmp_path), "rows*.parquet", with_file=True).collect()
    assert sorted(r["id"] for r in back) == [0, 1, 2] and all(r["shard_file"].startswith("part-") for r in back)
    # a file beside the folder is a shard as well
    spark.range(7, 8).coalesce(1).write.parquet(str(tmp_path / "one"))
    (file,) = glob.glob(str(tmp_path / "one" / "part-*.parquet"))
    shutil.copy(file, tmp_path / "rows-2.parquet")
    assert sorted(r["id"] for r in R.scan_parquet_shards(spark, str(tmp_path), "rows*.parquet").collect()) == [0, 1, 2, 7]


def test_shards_behind_mounts(spark, tmp_path):
    # each table is a mount of its own, so the folder above them is in no store
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    spark.range(3).repartition(2).write.parquet(str(tmp_path / "elsewhere"))
    spark.range(5, 6).write.parquet(str(tmp_path / "other"))
    for name, place in (("rows.parquet", "elsewhere"), ("other.parquet", "other")):
        hadoop.set(f"fs.viewfs.mounttable.shards.link./{name}", f"file://{tmp_path / place}")
    for pattern in ("rows.parquet", "rows*.parquet"):
        assert sorted(r["id"] for r in R.scan_parquet_shards(spark, "viewfs://shards", pattern).collect()) == [0, 1, 2]
    assert R.scan_parquet_shards(spark, "viewfs://shards", "*.parquet").count() == 4


def test_shards_beside_a_partitioned_table(spark, tmp_path):
    spark.range(3).withColumn("k", F.col("id")).write.partitionBy("k").parquet(str(tmp_path / "other.parquet"))
    spark.range(4).coalesce(1).write.parquet(str(tmp_path / "_made"))
    (file,) = glob.glob(str(tmp_path / "_made" / "part-*.parquet"))
    shutil.copy(file, tmp_path / "rows.parquet")
    assert R.scan_parquet_shards(spark, str(tmp_path), "rows.parquet").count() == 4
    # marks of a pattern in a folder's name
    spark.range(6).write.parquet(str(tmp_path / "rows[1].parquet"))
    assert R.scan_parquet_shards(spark, str(tmp_path), "rows?1?.parquet").count() == 6


def test_jsonl_keeps_nulls_and_unicode(spark, tmp_path):
    path = str(tmp_path / "rows")
    df = spark.createDataFrame([("a.wav", "日本 \n x", None)], "audio string, text string, prompt string")
    W.write_jsonl(df, path)
    assert spark.read.text(path).first()[0] == '{"audio":"a.wav","text":"日本 \\n x","prompt":null}'
    W.write_jsonl(df.limit(0), str(tmp_path / "none"))
    both = R.scan_jsonl(spark, {"train": path, "validation": str(tmp_path / "none")}).collect()
    assert [(r["text"], r["split"]) for r in both] == [("日本 \n x", "train")]


def test_export_makes_every_split(spark, tmp_path):
    df = spark.range(3).withColumn("split", F.lit("train"))
    W.export_splits(df, str(tmp_path / "x"))
    back = R.scan_jsonl(spark, {s: str(tmp_path / "x" / f"split={s}") for s in ("train", "eval")}, "id bigint").collect()
    assert sorted((r["id"], r["split"]) for r in back) == [(0, "train"), (1, "train"), (2, "train")]


def test_rejected_order(spark, tmp_path):
    path = str(tmp_path / "rejected")
    df = spark.createDataFrame([(0, 5), (1, 9), (2, 5), (3, 7)], "i int, n int")
    W.write_rejected(df.repartition(3), path, "n", "i")
    assert [r["i"] for r in W.preview_rows(spark.read.schema("i int, n int").json(path), "i", 2, 6, ["i", "n"]).collect()] == [0, 1]
    import glob

    lines = [line for f in sorted(glob.glob(f"{path}/part-*")) for line in open(f)]
    assert [line.split(",")[0] for line in lines] == ['{"i":1', '{"i":3', '{"i":0', '{"i":2']


def test_splits_get_the_files_their_rows_need(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 < 6, "train").when(F.col("id") % 10 < 9, "eval").alias("split"))
    # small partitions are put together at run time, which would hide how the rows were dealt
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        W.export_splits(df.where("split is not null"), str(tmp_path / "out"), names=("train", "eval", "test"), file_rows=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {name: len(glob.glob(f"{tmp_path}/out/split={name}/part-*")) for name in ("train", "eval", "test")}
    assert 3 <= files["train"] <= 6 and 2 <= files["eval"] <= 3
    back = R.scan_jsonl(spark, {n: f"{tmp_path}/out/split={n}" for n in files}, "id bigint")
    assert {r["split"]: r["count"] for r in back.groupBy("split").count().collect()} == {"train": 600, "eval": 300}


def write_wav(path, frames, sr=16000, channels=1):
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(sr)
        w.writeframes(struct.pack(f"<{frames * channels}h", *([7] * frames * channels)))


def test_audio_manifest(spark, tmp_path):
    write_wav(tmp_path / "a.wav", 16000)
    write_wav(tmp_path / "b.wav", 100, sr=8000, channels=2)
    (tmp_path / "c.wav").write_bytes(b"RIFF but no audio")
    (tmp_path / "d.txt").write_text("skip")
    assert sorted(r["path"][-5:] for r in U.list_audio(spark, str(tmp_path)).collect()) == ["a.wav", "b.wav", "c.wav"]
    rows = {r["path"][-5:]: r for r in U.scan_audio_manifest(spark, str(tmp_path)).collect()}
    assert {k: (r["sr"], r["channels"], r["duration"]) for k, r in rows.items()} == {
        "a.wav": (16000, 1, 1.0), "b.wav": (8000, 2, 0.0125), "c.wav": (None, None, -1.0),
    }


def test_a_long_file_costs_its_header(spark, tmp_path):
    # a second, an hour-long sparse file of a gigabyte, and one with a megabyte of notes before its samples
    write_wav(tmp_path / "a.wav", 16000)
    write_wav(tmp_path / "b.wav", 0)
    with open(tmp_path / "b.wav", "r+b") as f:
        f.seek(40)
        f.write(struct.pack("<I", (1 << 30) - 44))
        f.truncate(1 << 30)
    notes = b"LIST" + struct.pack("<I", 1_000_001) + bytes(1_000_002)
    head, body = (tmp_path / "a.wav").read_bytes()[:36], (tmp_path / "a.wav").read_bytes()[36:]
    (tmp_path / "c.wav").write_bytes(head + notes + body)
    rows = {r["path"][-5:]: r for r in U.scan_audio_manifest(spark, str(tmp_path)).collect()}
    assert rows["b.wav"]["length"] == 1 << 30 and rows["b.wav"]["duration"] == ((1 << 30) - 44) / 32000
    assert rows["c.wav"]["duration"] == 1.0 and all(r["header_bytes"] < 1000 for r in rows.values())


def test_headers():
    pcm = lambda size, head=b"RIFF": head + struct.pack("<I", 36 + size) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 2, 8000, 32000, 4, 16)
    read = lambda data, length=None: U.read_header(io.BytesIO(data), len(data) if length is None else length)
    data = lambda size: b"data" + struct.pack("<I", size)
    assert read(pcm(32) + data(32) + bytes(32)).duration == 8 / 8000
    # more promised than there is, and a last frame that is not whole
    assert read(pcm(32) + data(400) + bytes(31)).duration == 7 / 8000
    wide = pcm(0, b"RF64").replace(b"fmt ", b"ds64" + struct.pack("<IQQQ", 24, 0, 64, 16) + b"fmt ", 1)
    assert read(wide + data(0xFFFFFFFF) + bytes(64)).duration == 16 / 8000
    for broken in (b"", b"RIFF", pcm(0), pcm(0)[:30], b"RIFX" + pcm(0)[4:] + data(0), pcm(0).replace(struct.pack("<I", 8000), bytes(4)) + data(4) + bytes(4)):
        assert read(broken).duration == -1.0 and read(broken).sr is None
    assert read(b"RIFF" + bytes(4) + b"WAVE" + (b"junk" + bytes(4)) * 5000).header_bytes < 9000


def test_files_are_dealt_by_what_they_cost(spark, tmp_path):
    for k in range(20):
        write_wav(tmp_path / f"{k:02d}.wav", 10)
    wavfiles.register(spark)
    df = spark.read.format(wavfiles.NAME).option("partition_bytes", str(4 * wavfiles.OPEN_BYTES)).load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 5 and df.count() == 20
    U.write_audio_files(df.limit(0).select(F.lit("x").alias("name"), F.lit(b"").alias("content")), str(tmp_path / "none"))
    assert U.scan_audio_manifest(spark, str(tmp_path / "none")).count() == 0
    twice = spark.createDataFrame([("a.wav", b"1"), ("b.wav", b"22")], "name string, content binary")
    for _ in range(2):
        U.write_audio_files(twice, str(tmp_path / "twice"))
    assert sorted(p.name for p in (tmp_path / "twice").iterdir() if not p.name.endswith(".crc")) == ["a.wav", "b.wav"]


def test_inputs(column):
    x = F.col("x")
    cases = {
        "http://a/b": "url", "HTTPS://a": "url", "http:///x": "path", "ftp://a": "path", "data:audio/wav;base64,/x": "base64",
        "a" * 256: "path", "a" * 257: "base64", "a/" * 200: "path", "c\\" * 200: "path", "": "path",
    }
    assert column(list(cases), U.classify_audio_input(x)) == list(cases.values())
    payloads = ["aGk=", "data:audio/wav;base64,aGk=", "  data:x,aGk=", "@@@@", None]
    assert column(payloads, U.decode_base64_payload(x)) == [b"hi", b"hi", b"hi", None, None]
    bodies = [struct.pack("<3f", 1.0, -2.5, 0.0), b"", b"abc", None]
    assert column(bodies, U.decode_pcm_f32(x), "binary") == [[1.0, -2.5, 0.0], [], None, None]


def test_wav_bytes_are_readable(spark):
    df = spark.createDataFrame([([0, -1, 32767, -32768],)], "s array<smallint>")
    row = df.select(U.wav_header(U.wav_bytes(F.col("s"), 4)).alias("h")).first()["h"]
    assert (row["sr"], row["channels"], row["duration"]) == (4, 1, 1.0)


def test_corpus_plan(spark, tmp_path):
    texts = ["hello there", "你好", "123", "x" * 40, ""] + [f"sample number {i}" for i in range(30)]
    data = [([("<audio>", "user"), (t, "assistant")], [f"{i}.wav"]) for i, t in enumerate(texts)]
    samples = spark.createDataFrame(data, R.RAW_SAMPLE)
    rows = corpus.convert(samples, "/clips")
    assert rows.count() == len(texts) - 1
    corpus.write_converted(rows, str(tmp_path / "out"), 3)
    undetected = spark.read.schema("audio string, text string").json(str(tmp_path / "out" / "undetected_languages")).collect()
    assert [tuple(r) for r in undetected] == [("/clips/2.wav", "123")]
    shards = R.scan_parquet_shards(spark, str(tmp_path / "out" / "shards")).drop("shard")
    assert sorted(shards.collect()) == sorted(rows.collect())
    kept = corpus.filter_by_length(shards, str(tmp_path / "rejected"), max_chars=100)
    assert kept.count() == len(texts) - 2
    durations = rows.select("audio", F.when(F.col("audio") == "/clips/0.wav", 31.0).otherwise(2.0).alias("duration"))
    kept = corpus.filter_by_duration(kept, durations, 30.0)
    assert kept.count() == len(texts) - 3
    split = corpus.split_and_export(kept, str(tmp_path / "final"), ratio=0.1)
    want = math.ceil(0.1 * (len(texts) - 3))
    assert split.where("split = 'eval'").count() == want
    assert R.scan_jsonl(spark, {"eval": str(tmp_path / "final" / "split=eval")}).count() == want


def test_convert_tells_latin_languages_apart(spark):
    taught = [(0, "the cat and the dog with that hat", "en"), (1, "les chats et le chien avec une maison", "fr")]
    profile = trigram_profile(spark.createDataFrame(taught, "i int, t string, l string"), "t", "l", ("en", "fr"))
    texts = ["the dog and that cat", "le chien et les maisons", "مرحبا بكم", "the dog and that cat"]
    samples = spark.createDataFrame(
        [([{"role": "assistant", "content": t}], [f"{i}.wav"]) for i, t in enumerate(texts)],
        "messages array<struct<content:string,role:string>>, audios array<string>",
    )
    rows = corpus.convert(samples, profile=profile, labels=("en", "fr")).orderBy("audio").collect()
    assert [r["text"].split("<asr_text>")[0] for r in rows] == [
        "language English", "language French", "language Arabic", "language English"
    ]
