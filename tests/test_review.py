import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxsieve.functions import signal as sg
from voxsieve.plans import route
from voxsieve.policy import Policy
from voxsieve.sources import review

SCHEMA = (
    "row_id long, candidate_id string, group_key string, uid string, split string, wake_text string, lang string, role string, arm string, stream string, view string, source_wav string, pcm_sha256 string, score_key string, "
    "raw_parent_candidate_id string, cer_route double, nll double, q_kw double, qkw_calibrated boolean, extra_ratio double, validity string, content_class string, s7_available boolean, decode_ok boolean, deleted_at timestamp"
)


@pytest.fixture
def scored(spark, tmp_path):
    """Three groups: raw and enhanced views of two roles with real recordings, and one candidate that couldn't be decoded."""
    rows = []
    for g, (split, uid) in enumerate([("pos", "u_1"), ("pos", "u_10"), ("neg", "u_2")]):
        for k, (role, view) in enumerate([("s1", "raw"), ("s1", "moss48k"), ("s7", "raw")]):
            path = tmp_path / "in" / f"{split}_{uid}_{role}_{view}.wav"
            path.parent.mkdir(exist_ok=True)
            x = np.sin(np.arange(1600) / (5 + 3 * g + k)).astype(np.float32) * 0.3
            path.write_bytes(sg.encode_wav(x))
            pcm = sg.pcm_digest(*sg.decode_wav(path.read_bytes()))
            ident = f"C-{split}-{uid}-{role}-{view}-original"
            parent = f"C-{split}-{uid}-{role}-raw-original" if view != "raw" else None
            rows.append((len(rows), ident, f"{split}\0{uid}", uid, split, "hicolmo", "en", role, role, "original", view, str(path), pcm, f"k{len(rows)}", parent, [0.2, 0.2, 0.1][k] if g else 0.0, 1.0, None, False, 0.0, "rankable", "target_wake", True, True, None))
    rows.append((len(rows), "C-neg-u_2-s7-moss48k-original", "neg\0u_2", "u_2", "neg", "hicolmo", "en", "s7", "s7", "original", "moss48k", None, None, None, None, None, None, None, False, None, "fatal_invalid", None, True, False, None))
    return spark.createDataFrame(rows, SCHEMA)


def test_the_whole_way(spark, scored, tmp_path):
    report = route.run(spark, scored, f"file://{tmp_path}/out", Policy(), package=True)
    assert report["review"]["ok"] and report["review"]["n_candidates"] == 10 and report["review"]["placeholder"] == 1 and report["review_faults"] == []
    assert report["review"]["reasons"] == {"KEEP_S1_CER0_TRUSTED": 1, "SWITCH_S7_LOWER_CER": 2} and report["paired"]["n_better"] == 2
    names = sorted(p.name for p in (tmp_path / "out" / "review").iterdir() if not p.name.startswith(("_", ".")))
    assert len(names) == 13 and [n for n in names if "SELECTED" in n] == [n for n in names if n.split("__")[2] == "0000"]
    for prefix in {n[:16] for n in names}:  # a group's names stand together, the selected one first, the reasons last
        mine = [n for n in names if n.startswith(prefix)]
        assert "SELECTED" in mine[0] and mine[-1].endswith(review.REASONS)
    chosen = sorted(str(p.relative_to(tmp_path / "out" / "selected")) for p in (tmp_path / "out" / "selected").rglob("*.wav"))
    assert chosen == ["neg/u_2.wav", "pos/u_1.wav", "pos/u_10.wav", "pos/u_1__se.wav"]
    index = [json.loads(x) for p in sorted((tmp_path / "out" / "review" / "_index").glob("part*")) for x in p.read_text().splitlines()]
    assert [r["group_order"] for r in index] == sorted(r["group_order"] for r in index) and len(index) == 10
    again = route.run(spark, scored, f"file://{tmp_path}/out", Policy(), package=True)
    assert again["review"]["existing"] == 9 and again["review_faults"] == []


def test_faults_are_found(spark, scored, tmp_path):
    out = tmp_path / "out"
    route.run(spark, scored, f"file://{out}", package=True)
    names = sorted((out / "review").glob("*REJECTED*.wav"))
    names[0].unlink()
    names[1].unlink()  # a hard link: the source keeps its samples
    names[1].write_bytes(sg.encode_wav(np.zeros(100)))
    (out / "review" / "000009__aaaaaaaa__0000__stray.wav").write_bytes(names[2].read_bytes())
    next((out / "review").glob(f"*{review.REASONS}")).unlink()
    expected = spark.createDataFrame([("pos", "u_1"), ("pos", "u_77")], "split string, uid string")
    got = {r.fault: r.n for r in review.review_faults(spark, f"file://{out}/review", expected).collect()}
    assert got == {"no recording": 1, "other samples": 1, "not in the index": 1, "not one document of reasons": 1, "no group": 1}


def test_failures_and_collisions(spark, scored, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"1")
    (tmp_path / "b.wav").write_bytes(b"2")
    assert review.link_or_copy(str(tmp_path / "a.wav"), f"file://{tmp_path}/x/a.wav") == "hardlink" and review.link_or_copy(str(tmp_path / "a.wav"), f"{tmp_path}/x/a.wav") == "existing"
    with pytest.raises(review.Collision):
        review.link_or_copy(str(tmp_path / "b.wav"), f"{tmp_path}/x/a.wav")
    broken = scored.where("split = 'neg'").withColumn("decode_ok", F.lit(False)).withColumns({"source_wav": F.lit(None).cast("string"), "cer_route": F.lit(None).cast("double")})
    report = route.run(spark, scored.where("split = 'pos'").unionByName(broken), f"file://{tmp_path}/out", package=True)
    assert not report["review"]["ok"] and report["review"]["n_failures"] == 1 and not (tmp_path / "out" / "selected").exists()
    assert "failures reported" in {r["fault"] for r in report["review_faults"]}
    with pytest.raises(review.NotWritten):
        review.write_selected(scored, scored, f"file://{tmp_path}/out/selected", report["review"])


def test_scored_anew(spark, scored):
    sidecar = spark.createDataFrame([(i, f"C-pos-u_1-{r}", None, None, None, None, hyp, 0.5, q, kind, digest) for i, (r, hyp, q, kind, digest) in enumerate([("s1-raw-original", "hi colmo", 0.9, "calibrated_qkw", "good"), ("s1-moss48k-original", "colmo", 0.9, "calibrated_qkw", "bad"), ("s7-raw-original", "something else", None, "nll", None)])], "row_id long, candidate_id string, score_key string, pcm_sha256 string, wake_text string, lang string, hyp string, nll double, q_kw double, score_kind string, calibrator_hash string")
    from voxsieve.operators.selection import candidates

    got = {r.candidate_id[10:]: r for r in route.rescored(candidates(scored), sidecar, "good").where("uid = 'u_1'").collect()}
    assert got["s1-raw-original"].cer_route == 0 and got["s1-raw-original"].q_kw == 0.9 and got["s1-raw-original"].validity == "rankable"
    assert got["s1-moss48k-original"].q_kw is None and got["s1-moss48k-original"].cer_route > 0
    assert got["s7-raw-original"].validity == "semantic_ineligible"
    rest = route.rescored(candidates(scored), sidecar, "good").where("uid <> 'u_1'")
    assert rest.where("validity <> 'fatal_invalid' or cer_route is not null").count() == 0 and rest.count() == 7
