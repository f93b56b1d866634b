import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxsieve.functions import calibration as cal
from voxsieve.functions import lineage, scalars
from voxsieve.functions import signal as sg
from voxsieve.functions import text as tx
from voxsieve.operators import crops
from voxsieve.operators.reporting import file_names, loss_reasons, set_fingerprint
from voxsieve.sources import audio, jsonl


def errors(spark, *pairs):
    return {(r.hyp, r.ref): r for r in tx.text_errors(spark.createDataFrame(list(pairs), "hyp string, ref string"), "hyp", "ref").collect()}


def test_text_errors(spark):
    got = errors(spark, ("heycolmo", "hicolmo"), ("hello world", "hicolmo"), ("colmo", "hicolmo"), ("科目", "科慕"), ("HeyColmo!", "hicolmo"), (None, "hey"), ("x", None), ("", ""), ("ok lumio now", "OK Lumio"), ("小路", "小路小路"), ("小 路，小路", "小路小路"))
    assert got["heycolmo", "hicolmo"].cer_route == 0 and got["heycolmo", "hicolmo"].core_hit and got["HeyColmo!", "hicolmo"].cer_route == 0
    assert got["hello world", "hicolmo"].cer_route > 0 and not got["hello world", "hicolmo"].core_hit
    assert got["colmo", "hicolmo"].cer_route > 0 and got["colmo", "hicolmo"].core_hit
    zh = got["科目", "科慕"]
    assert zh.cer_route == 0 and zh.cer_char == 0.5 and zh.metric == "toneless_pinyin_cer" and zh.alias_hit is None
    assert got[None, "hey"].cer_route == 1 and got["x", None].cer_route == 1 and got["", ""].cer_route == 0
    more = got["ok lumio now", "OK Lumio"]
    assert more.extra_ratio == pytest.approx(1 / 3) and more.wake_coverage == 1 and more.cer_route == pytest.approx(4 / 8)
    assert got["小路", "小路小路"].wake_coverage == 1 and got["小路", "小路小路"].cer_route == 0.5 and got["小 路，小路", "小路小路"].cer_route == 0


def row_wise(hyp, ref, syllable):
    """The text-error record of one pair, straight from its definition."""
    import unicodedata

    bare = str.maketrans("", "", tx.PUNCTUATION)
    norm = lambda t: unicodedata.normalize("NFKC", t or "").lower().translate(bare).strip()
    chars = lambda t: "".join(c for c in unicodedata.normalize("NFKC", t or "") if not c.isspace()).translate(bare).lower()

    def share(a, b):
        if not b:
            return float(bool(a))
        row = list(range(len(a) + 1))
        for i, y in enumerate(b, 1):
            new = [i]
            for j, x in enumerate(a, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1] / len(b)

    hc, rc, he, re_ = chars(hyp), chars(ref), " ".join(norm(hyp).split()), " ".join(norm(ref).split())
    if any("\u4e00" <= c <= "\u9fff" for c in ref or ""):
        route = share("".join(map(syllable, hc)), "".join(map(syllable, rc)))
        ht, rt = list(norm(hyp).replace(" ", "")), list(norm(ref).replace(" ", ""))
        cover, alias = rt, None
    else:
        options = dict.fromkeys([re_, *tx.ALIASES.get(re_, []), rc or re_])
        route, _, alias = min((share(he, a), len(a), a) for a in options)
        ht, rt, cover = he.split(), re_.split(), alias.split()
    core = cover[-1] if cover else ""
    core = "colmo" if alias and core.endswith("colmo") else core
    hits = sum(t in ht or chars(t) in hc for t in cover)
    return route, share(hc, rc), alias, hits / len(cover) if cover else 0.0, max(0, len(ht) - len(rt)) / max(1, len(ht)), bool(core) and core in hc


def test_text_errors_of_a_whole_table(spark):
    from tests.duck import ROOT
    from voxsieve.sources.tables import table

    read = tx.syllable_table(spark)
    rows = tx.text_errors(table(spark, f"{ROOT}/sf0.01", "sidecar"), "hyp", "wake_text").collect()
    assert len(rows) > 4000
    for r in rows:
        route, char, alias, coverage, extra, core = row_wise(r.hyp, r.wake_text, lambda c: read.get(c, c))
        assert (r.cer_route, r.cer_char, r.wake_coverage, r.extra_ratio) == pytest.approx((route, char, coverage, extra)), r
        assert (r.alias_hit, r.core_hit) == (alias, core), r


def test_normalising(spark):
    d = spark.createDataFrame([(" Ｈｅｙ，　you! ",), ("İ",), (None,), ("",)], "t string")
    got = d.select(tx.normal_text(F.col("t")).alias("a"), tx.normal_chars(F.col("t")).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [("hey  you".replace("  ", " "), "heyyou"), ("i̇", "i̇"), ("", ""), ("", "")]


def test_languages_and_streams(spark):
    d = spark.createDataFrame([("EN", "x", '{"peak": {}, "original": {}, "spk1": {}}'), ("zh-CN", "小路", '[{"name": "spk2"}, {"id": "peak"}, {"x": 1}]'), (None, "hey", '["original", "", "spk1", "peak"]'), (None, " ", None), ("cn", None, "not json")], "l string, w string, s string")
    lang, origin = tx.language_of(F.col("l"), F.col("w"))
    got = d.select(lang.alias("a"), origin.alias("b"), F.array_join(tx.stream_names(F.col("s")), ",").alias("c")).collect()
    assert [(r.a, r.b, r.c) for r in got] == [("en", "index_lang", "original,spk1"), ("zh", "inferred_from_wake_text", "spk2,original"), ("en", "inferred_from_wake_text", "original,spk1"), ("", "missing_wake_text", ""), ("zh", "index_lang", "")]


def test_scalars(spark):
    d = spark.createDataFrame([("1.5",), ("nan",), ("inf",), ("x",), (None,)], "v string")
    assert [r[0] for r in d.select(scalars.finite(F.col("v"))).collect()] == [1.5, None, None, None, None]
    d = spark.createDataFrame([("pos_10",), ("pos_9",), ("Pos_010b",), ("pos_2",)], "v string")
    assert [r.v for r in d.orderBy(scalars.natural_key(F.col("v")), "v").collect()] == ["pos_2", "pos_9", "pos_10", "Pos_010b"]
    e = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0], [1.0, 2.0]), ([0.0], [1.0]), (None, [1.0]), ([3.0, 4.0], [3.0, 4.0])], "a array<double>, b array<double>")
    assert [r[0] for r in e.select(scalars.cosine(F.col("a"), F.col("b"))).collect()] == [0.0, None, None, None, 1.0]
    import hashlib
    import json

    row = spark.createDataFrame([("p", "小路", None)], "pcm_sha256 string, wake_text string, lang string")
    want = {"pcm_sha256": "p", "wake_text": "小路", "lang": None, "alias_set_hash": "a", "text_normalizer_hash": None, "aligner": "x", "model_hash": "m", "runtime_hash": "r"}
    key = crops.alignment_key(F.lit("x"), F.lit("m"), F.lit("r"), F.lit("a"), F.lit(None).cast("string"))
    assert row.select(key.alias("k")).first().k == hashlib.sha256(json.dumps(want, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def test_long_numbers_are_ordered_as_numbers(spark):
    numbers = [7, 10**19, 10**20 + 5, 10**20 + 50, 10**21, 3 * 10**40, 10**41]
    want = [f"u{n}_a" for n in numbers]
    d = spark.createDataFrame([(v,) for v in reversed(want)], "v string")
    assert [r.v for r in d.orderBy(scalars.natural_key(F.col("v"))).collect()] == want
    same = spark.createDataFrame([("u007b", "U7b"), ("u0", "u000")], "a string, b string")
    assert same.where(scalars.natural_key(F.col("a")) == scalars.natural_key(F.col("b"))).count() == 2


def logp(rows):
    x = np.log(np.array(rows, float))
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def test_alignment():
    lp = logp([[8, 1, 1, 1], [8, 1, 1, 1], [1, 8, 1, 1], [1, 8, 1, 1], [1, 1, 8, 1], [8, 1, 1, 1], [8, 1, 1, 1]])
    a = sg.align(lp, [1, 2])
    assert (a.start_frame, a.end_frame, a.blank_ratio) == (3, 4, 0.0)  # frames before the path are free, so it begins late
    same = sg.align(logp([[9, 1, 1], [1, 9, 1], [9, 1, 1], [1, 9, 1], [9, 1, 1], [9, 1, 1]]), [1, 1])
    assert (same.start_frame, same.end_frame) == (1, 3)
    for bad in (lambda: sg.align(lp, []), lambda: sg.align(lp * np.nan, [1]), lambda: sg.align(lp, [9]), lambda: sg.align(lp[:1], [1, 1])):
        with pytest.raises(ValueError):
            bad()


def test_alignment_is_the_best_path():
    """Against all paths of a small matrix: free start, blanks paid to the last frame."""
    rng = np.random.default_rng(4)
    for _ in range(30):
        lp = logp(rng.random((5, 3)) + 0.05)
        tokens = [int(x) for x in rng.integers(1, 3, 2)]
        labels = [0, tokens[0], 0, tokens[1], 0]
        best = -math.inf

        def walk(t, s, total):
            nonlocal best
            total += lp[t, labels[s]]
            if t == 4:
                if s >= 3:
                    best = max(best, total)
                return
            for n in (s, s + 1, s + 2):
                if n < 5 and (n < s + 2 or (n % 2 and labels[n] != labels[s])):
                    walk(t + 1, n, total)

        for t in range(5):
            for s in (0, 1):
                walk(t, s, 0.0)
        if best == -math.inf:
            continue
        a = sg.align(lp, tokens)
        tail = lp[a.end_frame + 1 :, 0].sum()
        assert a.align_logp_sum + tail <= best + 1e-9
        assert a.align_logp_sum + tail == pytest.approx(best) or a.start_frame > 0


def tone(seconds=0.6, rate=16_000):
    x = 0.25 * np.sin(np.arange(int(seconds * rate)) * 2 * np.pi * 440 / rate).astype(np.float32)
    x.reshape(-1, 320)[::4] *= 0.02
    return x


def test_audio_features(spark, tmp_path):
    q = sg.quality(tone(), 16_000)
    assert q["duration_sec"] == 0.6 and q["snr_valid"] and q["band_energy_mid"] > 0.9 and q["longest_speech_sec"] == pytest.approx(0.06) and q["speech_ratio"] == pytest.approx(22 / 30, abs=0.05)
    assert sg.quality(np.zeros(0), 16_000)["fatal_invalid"] and sg.quality(np.array([np.nan]), 16_000)["fatal_invalid"]
    assert sg.quality(np.ones(1), 16_000)["clip_rate"] == 1.0
    y = sg.denoised(tone(), 16_000)
    assert len(y) == len(tone()) and np.isfinite(y).all() and np.abs(y).sum() <= np.abs(tone()).sum()
    arm = tmp_path / "pos" / "s1" / "wav"
    arm.mkdir(parents=True)
    data = sg.encode_wav(tone())
    x, rate = sg.decode_wav(data)
    assert rate == 16_000 and np.abs(x - tone()).max() < 1e-4 and len(sg.resampled(x, 16_000, 8_000)) == len(x) // 2
    for name in ("u_1_peak", "u_1_original", "u_1_spk1"):
        (arm / f"{name}.wav").write_bytes(data)
    (arm / "u_2_spk1.wav").write_bytes(b"junk")
    (arm.parent / "index.jsonl").write_text('{"uid": "u_1"}\n\n{"uid": "u_2"}\n')
    (tmp_path / "pos" / "best_sep").mkdir()
    (tmp_path / "pos" / "best_sep" / "index.jsonl").write_text('{"uid": "no"}\n')
    assert [(r.arm, r.split) for r in audio.read_arms(spark, str(tmp_path), "pos").collect()] == [("s1", "pos")] * 2
    rec = audio.recordings(spark, str(tmp_path), content=True)
    assert sorted((r.uid, r.stream, r.path.rpartition("_")[2]) for r in rec.collect()) == [("u_1", "original", "peak.wav"), ("u_1", "spk1", "spk1.wav"), ("u_2", "spk1", "spk1.wav")]
    states = lambda: sorted(r.status for r in audio.store_by_content(rec, f"file://{tmp_path}/store").collect())
    assert states()[-1] == "undecodable" and states() == ["hit", "hit", "undecodable"]
    cuts = rec.where("stream = 'spk1'").select("path", "content", F.lit("tight").alias("view"), F.lit(100).alias("start_sample"), F.lit(500).alias("end_sample"))
    cut = sg.cut_audio(cuts, fade_ms=5).collect()
    part, _ = sg.decode_wav(bytes(cut[0].content))
    assert len(cut) == 1 and len(part) == 400 and part[0] == 0 and cut[0].pcm_sha256 == sg.pcm_digest(part, 16_000)
    feats = {r.path.rpartition("/")[2]: r for r in sg.audio_features(rec).collect()}
    assert feats["u_2_spk1.wav"].fatal_invalid and feats["u_1_spk1.wav"].pcm_sha256 == sg.pcm_digest(x, rate)
    np.save(tmp_path / "a.npy", logp([[1, 9], [9, 1]]))
    np.savez(tmp_path / "b.npz", log_probs=logp([[1, 9]]))
    m = audio.read_matrices(spark, str(tmp_path)).withColumn("tokens", F.array(F.lit(1)))
    got = {r.path.rpartition("/")[2]: r.alignment for r in sg.alignments(m).collect()}
    assert got["a.npy"].start_frame == 0 and got["b.npz"].end_sec == pytest.approx(1 / 50)


def test_calibration(spark):
    rng = random.Random(8)
    rows = [(lang, s := rng.gauss(1.0 if y else -1.0, 1.0), y) for lang in ("en", "zh") for y in (0, 1) for _ in range(60)] + [("en", float("nan"), 1), ("en", None, 1)]
    df = spark.createDataFrame([(a, b, c) for a, b, c in rows], "lang string, s double, y int")
    models = cal.fit_logistic(df, "lang", "s", "y")
    for lang in ("en", "zh"):
        x = np.array([b for a, b, c in rows if a == lang and b is not None and not math.isnan(b)])
        y = np.array([c for a, b, c in rows if a == lang and b is not None and not math.isnan(b)])
        z, m = (x - x.mean()) / x.std(), models[lang]
        p = 1 / (1 + np.exp(-(m.slope * z + m.intercept)))
        assert abs(((p - y) * z).sum() + 1e-4 * m.slope) < 1e-6 and abs((p - y).sum()) < 1e-6
    got = df.select(cal.calibrated(F.col("s"), F.col("lang"), models).alias("p")).where("p is not null")
    assert got.where("p < 0 or p > 1").count() == 0 and got.count() == 240
    document = cal.to_document(models, "abc")
    assert cal.from_document(document) == models
    document["models"]["en"]["intercept"] += 1
    with pytest.raises(cal.CalibrationError):
        cal.from_document(document)
    with pytest.raises(cal.CalibrationError):
        cal.fit_logistic(df.where("y = 1"), "lang", "s", "y")
    with pytest.raises(cal.CalibrationError):
        cal.fit_logistic(df.withColumn("s", F.lit(1.0)), "lang", "s", "y")


def test_crops(spark):
    schema = "source string, start_sec double, end_sec double, valid boolean, target_score double, n_samples int, sample_rate int"
    occ = spark.createDataFrame([("a", 0.1, 0.5, True, 1.0, 16000, 16000), ("b", 0.1, 0.3, None, 0.5, 16000, 16000), ("b", 0.4, 0.6, True, 0.9, 16000, 16000), ("c", 0.1, 2.0, True, 1.0, 16000, 16000), ("d", 0.2, 0.4, False, 1.0, 16000, 16000), ("e", None, 0.4, True, 1.0, 16000, 16000)], schema)
    got = {(r.source, r.view): (r.start_sample, r.end_sample, r.boundary_clamped) for r in crops.crop_specs(occ).collect()}
    assert {s for s, _ in got} == {"a"} and got["a", "keyword_tight"] == (320, 9920, False) and got["a", "speaker_ctx"] == (0, 16000, True)
    more = crops.crop_specs(occ, crops.CropPolicy(several=True, max_duration_sec=0.5)).collect()
    assert {(r.source, r.view, r.start_sample) for r in more if r.source == "b"} == {("b", "keyword_tight", 5120)}
    s = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "x array<float>").select(crops.cut_samples(F.col("x"), F.lit(1), F.lit(3)).alias("y"))
    assert s.first().y == [2.0, 3.0]


def test_names_fingerprints_and_losses(spark):
    d = spark.createDataFrame([("pos", "u1", "s1", "raw", "spk 1/é", None), ("neg", "u2", "s7", "moss48k", None, "abcdef0123")], "split string, uid string, role string, view string, stream string, pcm_sha256 string")
    names = [r[0] for r in d.select(file_names(F.lit(7), F.lit(1002), F.lit("REJECTED"))).collect()]
    assert names[0].startswith("000007__") and names[0].endswith("__1002__REJECTED__s1__raw__spk_1__P-undec") and names[1].endswith("__empty__P-abcdef01")
    one, two = set_fingerprint(d, ["split", "uid"]).first(), set_fingerprint(d.union(d).orderBy("uid"), ["split", "uid"]).first()
    assert one == two and one.n == 2 and set_fingerprint(d.limit(1), ["split", "uid"]).first() != one and set_fingerprint(d.limit(0), ["uid"]).first().n == 0
    c = spark.createDataFrame([("g", "a", "raw", "p", 0.1, 0.9, True, "rankable"), ("g", "b", "raw", "p", 0.1, 0.9, True, "rankable"), ("g", "c", "raw", "q", 0.2, None, False, "rankable"), ("g", "d", "moss48k", "r", 0.1, 0.95, True, "rankable"), ("g", "e", "raw", "s", 0.1, 0.5, True, "rankable"), ("g", "f", "raw", "t", None, None, None, "fatal_invalid")], "group_key string, candidate_id string, view string, pcm_sha256 string, cer_route double, q_kw double, qkw_calibrated boolean, validity string")
    got = {r.candidate_id: r.loss_reason for r in loss_reasons(c, c.where("candidate_id = 'a'")).collect()}
    assert got == {"b": "same_pcm_prefer_s1", "c": "higher_cer", "d": "deterministic_raw_tie", "e": "equal_cer_lower_qkw", "f": "fatal_invalid"}


def test_files_and_lineage(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"b": 1, "a": "小", "x": [1]}\n\n  {"a": null}\n')
    assert [tuple(r) for r in jsonl.read_jsonl(spark, f"{tmp_path}/a.jsonl", "a string, b int").collect()] == [("小", 1), (None, None)]
    (tmp_path / "bad.jsonl").write_text('{"a": "x"}\n[1]\n{"a"\n')
    assert jsonl.read_jsonl(spark, f"{tmp_path}/bad.jsonl", "a string", strict=False).count() == 1
    with pytest.raises(Exception, match="not a JSON object"):
        jsonl.read_jsonl(spark, f"{tmp_path}/bad.jsonl", "a string").collect()
    jsonl.write_jsonl(spark.createDataFrame([(1, "小", None)], "b int, a string, c string"), f"{tmp_path}/out")
    assert [r.value for r in spark.read.text(f"{tmp_path}/out").collect()] == ['{"a":"小","b":1,"c":null}']
    (tmp_path / "t.txt").write_text('k1 hello there\n{"key": "k2", "text": "hi"}\nk1 again\nk3\n')
    assert {r.key: r.text for r in jsonl.read_transcripts(spark, f"{tmp_path}/t.txt").collect()} == {"k1": "again", "k2": "hi", "k3": ""}
    jsonl.write_document(f"{tmp_path}/d.json", {"z": 1})
    assert jsonl.read_document(f"{tmp_path}/d.json") == {"z": 1}
    model = tmp_path / "model"
    model.mkdir()
    (model / "config.json").write_text("{}")
    (model / "model.safetensors").write_bytes(b"1")
    before = lineage.folder_digest(model)
    (model / "model.safetensors").write_bytes(b"2")
    assert lineage.folder_digest(model) != before and lineage.file_digest(None) is None
    assert lineage.claim(tmp_path / "run", {"a": 1}) == lineage.claim(tmp_path / "run", {"a": 1})
    with pytest.raises(lineage.OtherRun):
        lineage.claim(tmp_path / "run", {"a": 2})


def test_large_sets_and_orders(spark):
    many = spark.range(200_000).select(F.col("id").cast("string").alias("uid"), F.lit("pos").alias("split"))
    a, b = (set_fingerprint(d, ["split", "uid"]).first() for d in (many, many.unionByName(many.limit(10)).repartition(7)))
    assert a == b and a.n == 200_000 and set_fingerprint(many.where("uid <> '5'"), ["split", "uid"]).first().fingerprint != a.fingerprint
    row = spark.createDataFrame([(1_000_001, 12_345, "u", "pos", "s1", "raw", "original", None)], "o long, s long, uid string, split string, role string, view string, stream string, pcm_sha256 string")
    name = row.select(file_names(F.col("o"), F.col("s"), F.lit("REJECTED")).alias("n")).first().n
    assert name.startswith("1000001__") and "__12345__REJECTED__" in name


def test_alias_tables_and_signatures(tmp_path):
    path = tmp_path / "aliases.json"
    path.write_text('{"Hi  Colmo": "hello colmo!", "wake": ["Wake up", "wake"]}')
    table = tx.alias_table(str(path))
    assert table["hi colmo"][-1] == "hello colmo" and table["wake"] == ["wake", "wake up"] and tx.alias_digest(table) != tx.alias_digest(tx.alias_table())
    path.write_text('{"a": 3}')
    with pytest.raises(ValueError):
        tx.alias_table(str(path))
    one = lineage.run_signature({"nll_switch_margin": 0.01}, s1_arm="s1", asr_sidecar=path, se_backend="none")
    assert one["inference_signature"] == "none" and len(one["asr_sidecar_hash"]) == 64
    path.write_text("{}")
    assert lineage.run_signature({"nll_switch_margin": 0.01}, s1_arm="s1", asr_sidecar=path, se_backend="none")["signature_hash"] != one["signature_hash"]
    with pytest.raises(ValueError):
        lineage.run_signature(surprise=1)
