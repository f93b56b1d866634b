import datetime
import json
from collections import defaultdict

import pandas as pd

from tests.duck import ROOT
from voxsieve.operators import drift
from voxsieve.sources.tables import table


def kind(v):
    return "boolean" if isinstance(v, bool) else "number" if isinstance(v, (int, float)) else "string" if isinstance(v, str) else "array" if isinstance(v, list) else "object"


def content(v):
    if isinstance(v, dict):
        leaves = [content(x) for x in v.values() if not (isinstance(x, dict) and not x)]
        return "".join(leaves or map(str, v))
    if isinstance(v, list):
        return "".join(content(x) for x in v)
    text = json.dumps(v) if isinstance(v, bool) else str(v)
    try:
        return str(float(text))
    except ValueError:
        return text.replace(" ", "")


def brute(lines):
    """Every change of every feed, file by file; renames by the best match of values over lines that share an unusual value."""
    out = set()
    for feed, g in lines.groupby("feed_id"):
        before, last = None, {}
        for (_, name), h in g.sort_values(["written_at", "file_name"]).groupby(["written_at", "file_name"], sort=True):
            docs = []
            for body in h.body:
                try:
                    d = json.loads(body)
                    docs += [d] * isinstance(d, dict)
                except ValueError:
                    continue
            have = {k for d in docs for k in d}
            if before is not None:
                old = {k for d in before for k in d}
                gone, new = old - have, have - old
                shares = []
                for a in gone:
                    for b in new:
                        same = n = 0
                        for x in before:
                            mates = [y for y in docs if len({content(v) for v in x.values() if v is not None and len(content(v)) > 6} & {content(v) for v in y.values() if v is not None and len(content(v)) > 6}) >= 1]
                            scored = sorted(mates, key=lambda y: -sum(content(v) in {content(w) for w in y.values() if w is not None} for v in x.values() if v is not None))
                            if scored and x.get(a) is not None and scored[0].get(b) is not None:
                                n += 1
                                same += content(x[a]) == content(scored[0][b])
                        if n and same / n >= 0.6:
                            shares.append((same / n, a, b))
                for _, a, b in sorted(shares, reverse=True):
                    if a in gone and b in new:
                        gone.discard(a)
                        new.discard(b)
                        out.add((feed, name, "renamed", a, b))
                out |= {(feed, name, "removed", a, "") for a in gone} | {(feed, name, "added", "", b) for b in new}
            kinds = defaultdict(set)
            for d in docs:
                for k, v in d.items():
                    if v is not None:
                        kinds[k].add(kind(v))
            for k, ts in kinds.items():
                if before is not None and k in last and last[k] != ts and any(k in d for d in before):
                    out.add((feed, name, "retyped", k, k))
                last[k] = ts
            before = docs
    return out


def test_equals_brute_force(spark):
    for sf in ("sf0.001", "sf0.01"):
        lines = table(spark, f"{ROOT}/{sf}", "raw_lines")
        got = {tuple(r) for r in drift.changes(drift.materialised_cells(lines)).collect()}
        want = brute(pd.read_parquet(f"{ROOT}/{sf}/raw_lines.parquet"))
        assert got == want


T0 = datetime.datetime(2025, 1, 1)
LINES = "line_id long, feed_id long, family string, file_name string, written_at timestamp, body string, doc string, key string"


def lines_of(spark, files):
    rows, n = [], 0
    for i, bodies in enumerate(files):
        for b in bodies:
            n += 1
            rows.append((n, 1, "sidecar", f"f{i}", T0 + datetime.timedelta(days=i), b if b is None or isinstance(b, str) else json.dumps(b, ensure_ascii=False), "clash", "clash"))
    return spark.createDataFrame(rows, LINES)


def found(spark, files):
    return sorted(tuple(r)[1:] for r in drift.changes(drift.materialised_cells(lines_of(spark, files))).collect())


def test_nulls_gaps_and_unreadable_lines(spark):
    files = [
        [{"id": "u1", "a": 1, "b": None}, "", None, "{broken", "[1]", '{"x": 1} {"y": 2}', '{"z": 1}]'],
        [{"id": "u1", "a": None, "b": None}],
        [{"id": "u1", "a": "1", "b": True}],
        [{"id": "u1", "b": "yes"}, {"id": "u2", "b": "no", "A": [1]}],
        ["", "nonsense"],
        [{"id": "u1", "b": "yes", "a": 5}, {"id": "u2", "A": [2], "b": "no"}],
    ]
    assert found(spark, files) == [("f2", "retyped", "a", "a"), ("f3", "added", "", "A"), ("f3", "removed", "a", ""), ("f3", "retyped", "b", "b"), ("f5", "added", "", "a")]


def test_renames_follow_the_content_through_wrappers(spark):
    a = [{"uid": f"u{i}", "wake": f"phrase {i}", "n": i * 1.5, "lang": "en", "rev": 7 * i} for i in range(6)]
    b = [{"uid": f"u{i}", "phrase": [f"phrase {i}"], "m": str(i * 1.5), "language": {"code": "en"}, "other": 100 + i} for i in range(6)]
    assert found(spark, [a, b]) == [("f1", "added", "", "other"), ("f1", "removed", "rev", ""), ("f1", "renamed", "lang", "language"), ("f1", "renamed", "n", "m"), ("f1", "renamed", "wake", "phrase")]


def test_doubled_keys_and_empty_input(spark):
    assert found(spark, [['{"a": 1, "a": "x"}'], ['{"a": 1}']]) == [("f1", "retyped", "a", "a")]
    assert drift.changes(drift.materialised_cells(lines_of(spark, [[None]]).limit(0))).count() == 0


def test_lifespans(spark):
    files = [[{"a": 1}], [{"a": None}], [{"a": "x"}], [{"b": 1}], [{"a": "y"}]]
    cells = drift.materialised_cells(lines_of(spark, files))
    got = sorted((r.field, r.kind, r.first_no, r.last_no, r.n_files, r.n_values) for r in drift.lifespans(drift.catalogue(cells)[1]).collect())
    assert got == [("a", "number", 1, 2, 2, 1), ("a", "string", 3, 3, 1, 1), ("a", "string", 5, 5, 1, 1), ("b", "number", 4, 4, 1, 1)]


def test_one_consistent_table(spark):
    bodies = [
        {"candidateId": "c", "wake": ["hey"], "transcript": {"text": "hey you"}, "neg_log": "0.5", "qkw": 1, "decode_ok": "true", "token_count": "3", "calib.sha": {"sha256": "ab"}},
        {"candidate_id": "", "hyp": ["hello", "there"], "nll": 1e-1, "q_kw": None, "qkw": 0.25, "decode_ok": False, "token_count": "many", "dur_sec": "x"},
    ]
    a, b = drift.consistent_table(lines_of(spark, [bodies]), "sidecar").orderBy("line_id").collect()
    assert (a.candidate_id, a.wake_text, a.hyp, a.nll, a.q_kw, a.decode_ok, a.token_count, a.calibrator_hash) == ("c", "hey", "hey you", 0.5, 1.0, True, 3, "ab")
    assert (b.candidate_id, b.hyp, b.nll, b.q_kw, b.decode_ok, b.token_count, b.dur_sec) == ("", "hello there", 0.1, 0.25, False, None, None)


def test_fields_without_a_canonical_name_stay(spark):
    bodies = [
        {"candidate_id": "c", "beam": [4, 5], "rev": None, "hyp": None, "token_count": "many", "nll": 0.5, "neg_log": 0.75, "it's": {"a": 1}},
        {"candidate_id": "d", "lang": "en"},
    ]
    a, b = drift.consistent_table(lines_of(spark, [bodies]), "sidecar").orderBy("line_id").collect()
    assert a.nll == 0.5 and a.other_fields == {"beam": "[4,5]", "rev": "null", "token_count": '"many"', "neg_log": "0.75", "it's": '{"a":1}'}
    assert b.lang == "en" and b.other_fields == {}


def test_every_field_of_the_small_table_is_kept(spark):
    """Each non-null field of each line is in other_fields, or is a spelling of a canonical field that has a value."""
    lines = table(spark, f"{ROOT}/sf0.001", "raw_lines")
    bodies = {r.line_id: json.loads(r.body) for r in lines.where("try_parse_json(body) is not null and body like '{%'").collect()}
    for family in drift.FAMILY_FIELDS:
        known, n = drift.spellings_of(family), 0
        for r in drift.consistent_table(lines, family).collect():
            for k, v in bodies[r.line_id].items():
                n += k not in known
                if k not in known:
                    assert json.loads(r.other_fields[k]) == v
                elif v is not None:
                    assert k in r.other_fields or r[known[k]] is not None
        assert n


def test_casts_follow_renames_outside_the_alias_table(spark):
    """wake goes on as mot, then as ordet; a later, unrelated mot isn't taken for it."""
    line = lambda i, **more: {"uid": f"u{i}", "candidate_id": f"candidate {i}", "nll": i * 1.25 + 0.5} | more
    files = [
        [line(i, wake=f"phrase {i}") for i in range(6)],
        [line(i, mot=[f"phrase {i}"]) for i in range(6)],
        [line(i, ordet=f"phrase {i}", rev=i) for i in range(6)],
        [line(i, rev=i, mot=f"other {i}") for i in range(6)],
    ]
    got = drift.consistent_table(lines_of(spark, files), "sidecar").orderBy("line_id").collect()
    assert [r.wake_text for r in got] == [f"phrase {i}" for i in range(6)] * 3 + [None] * 6
    assert got[0].other_fields == {"uid": '"u0"'} and got[6].other_fields == {"uid": '"u0"'}
    assert got[12].other_fields == {"uid": '"u0"', "rev": "0"} and got[18].other_fields == {"uid": '"u0"', "rev": "0", "mot": '"other 0"'}
