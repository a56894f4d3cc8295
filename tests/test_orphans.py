import random

import pytest

from crateloom.plans import orphan_queries as Q
from tests import tables
from tests.tables import day


def brute(rows):
    first, gone = {}, {r["recording_id"] for r in rows["deleted_recordings"]}
    for r in rows["recordings"]:
        first[r["recording_id"]] = min(first.get(r["recording_id"], day(9999)), r["loaded_at"])
    out = set()
    for table, field, key in Q.FIELDS:
        for r in rows[table]:
            ref = r[field]
            if ref and first.get(ref, day(9999)) > r["loaded_at"]:
                kind = "deleted" if ref in gone else "later" if ref in first else "missing"
                out.add((table, field, r["loaded_at"].strftime("%Y-%m"), r[key], kind))
    return out


def test_against_brute_force(spark, tmp_path):
    rnd = random.Random(1)
    ids = [f"R{k}" for k in range(30)]
    rows = {
        "recordings": [dict(row_id=k, recording_id=rnd.choice(ids[:20]), loaded_at=day(rnd.randrange(90))) for k in range(30)],
        "deleted_recordings": [dict(recording_id=x, deleted_at=day(50)) for x in ids[18:24]],
        "credits": [dict(credit_id=f"C{k}", recording_id=rnd.choice([*ids, "", None]), loaded_at=day(rnd.randrange(90))) for k in range(120)],
        "relationships": [dict(relationship_id=f"L{k}", source_recording_id=rnd.choice(ids), target_recording_id=rnd.choice([*ids, None]), loaded_at=day(rnd.randrange(90))) for k in range(80)],
    }
    rows["credits"] += rows["credits"][:10]
    got = Q.p6_found(spark, tables.write(tmp_path / "t", rows)).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(brute(rows))


def test_deletion_reopens_resolved_references(spark):
    from crateloom.operators.orphans import OrphanState

    ref = spark.createDataFrame([("t", "f", "1", "A", day(5))], "table_name string, field_name string, record_id string, ref_id string, loaded_at timestamp_ntz")
    parent = spark.createDataFrame([("A", day(1))], "ref_id string, first_loaded timestamp_ntz")
    dead = spark.createDataFrame([("A", day(9))], "ref_id string, deleted_at timestamp_ntz")
    state = OrphanState().step(ref, parent, dead.limit(0))
    assert state.pending.count() == 0
    state.step(ref.limit(0), parent.limit(0), dead, resolved=ref)
    assert [r.kind for r in state.pending.collect()] == ["deleted"]


def test_snapshots_by_month_reopen_deleted(spark, tmp_path):
    rows = {
        "recordings": [dict(row_id=1, recording_id="A", loaded_at=day(65)), dict(row_id=2, recording_id="B", loaded_at=day(0))],
        "deleted_recordings": [dict(recording_id="B", deleted_at=day(95))],
        "credits": [dict(credit_id="1", recording_id="A", loaded_at=day(2)), dict(credit_id="2", recording_id="B", loaded_at=day(3))],
    }
    path = tables.write(tmp_path / "t", rows)
    start = day(2).strftime("%Y-%m")
    got = {(r.snapshot_no, r.load_month, r.kind, r.n_orphans) for r in Q.p6_snapshots(spark, path).collect()}
    month = lambda k: day(k).year * 12 + day(k).month - day(0).year * 12 - day(0).month + 1
    waiting = {(m, start, "missing", 1) for m in range(1, month(65))}
    assert got == waiting | {(m, start, "later", 1) for m in range(month(65), month(95) + 1)} | {(month(95), start, "deleted", 1)}
    assert [r.kind for r in Q.p6_found(spark, path).collect()] == ["later"]


@pytest.mark.parametrize("kind", ["empty", "awkward"])
def test_awkward_tables(spark, inputs, kind):
    for q in Q.QUERIES.values():
        rows = q(spark, inputs[kind]).collect()
        assert kind == "awkward" or rows == []
