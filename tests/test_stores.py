"""Imports that appear whole or not at all, states at a time, and ways back to them."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quire.operators import history, imports, snapshots

LOG = "id string, t int, seq int, v string, gone boolean"


def document(k, pid=None, previous=None):
    ids = f'<article-id specific-use="pid-v2">S{k}</article-id>' + (f'<article-id specific-use="pid-v3">{pid}</article-id>' if pid else "") + (f'<article-id specific-use="previous-pid">{previous}</article-id>' if previous else "")
    return f'<article><front><journal-meta><issn pub-type="epub">1111-1111</issn></journal-meta><article-meta>{ids}<pub-date pub-type="collection"><year>2020</year></pub-date><volume>3</volume><fpage>{k}</fpage></article-meta></front></article>'


PACKAGES = "package string, xml string, n_renditions int"


def state(spark, root):
    return {t: sorted(map(tuple, snapshots.read(spark, root, t, s).drop("xml", "digest").collect()), key=repr) for t, s in imports.SCHEMAS.items()}


def test_import_is_repeatable_and_keeps_the_first(spark, tmp_path):
    root = str(tmp_path / "s")
    packages = spark.createDataFrame([("b", document(1), 0), ("a", document(1), 2), ("c", document(2, "own"), 0), ("d", "<article>", 0), ("e", None, 0), ("f", "<article/>", 1)], PACKAGES)
    results, errors = imports.import_documents(spark, root, packages, "t1")
    assert sorted(r["package"] for r in results.collect()) == ["a", "b", "c"]
    assert {r["package"]: r["error"] for r in errors.collect()} == {"d": "could not parse the document: 10: not closed: article", "e": "there is no XML file in the package", "f": "no id"}
    first = state(spark, root)
    made = next(r[0] for r in first["documents"] if r[1] == "a")
    assert sorted(r[0] for r in first["documents"]) == sorted([made, "own"]) and len(made) == 23
    assert first["pids"] == [("S1", made, None), ("S2", "own", None)]
    assert [r[1:3] for r in first["changes"]] == [("Document", made), ("Document", "own"), ("DocumentRendition", made)]
    assert {r[0] for r in first["places"]} == {"1111-1111-2020-v3"} and snapshots.last_version(spark, root) == 1
    xml = {r["id"]: r["xml"] for r in snapshots.read(spark, root, "documents", imports.DOCUMENTS).collect()}
    assert f'specific-use="pid-v3">{made}</article-id>' in xml[made] and xml["own"] == document(2, "own")
    # again, and with one document more, whose id is known by its former one
    imports.import_documents(spark, root, packages, "t2")
    assert state(spark, root) == first and snapshots.last_version(spark, root) == 1
    results, _ = imports.import_documents(spark, root, packages.unionByName(spark.createDataFrame([("g", document(9, previous="S1"), 0), ("h", document(7), 0)], PACKAGES)), "t3")
    assert {r["package"]: r["pid_v3"] for r in results.collect()}["g"] == made
    assert len(state(spark, root)["documents"]) == 3 and snapshots.last_version(spark, root) == 2


@pytest.mark.parametrize("at", ["documents", "places", "manifest"])
def test_a_broken_import_shows_nothing(spark, tmp_path, monkeypatch, at):
    root = str(tmp_path / "s")
    one, two = (spark.createDataFrame([("a", document(1), 0)], PACKAGES), spark.createDataFrame([("b", document(2), 1)], PACKAGES))
    imports.import_documents(spark, root, one, "t1")
    before = state(spark, root)
    write, publish = snapshots.Commit.write, snapshots.Commit.publish

    def broken(self, table, rows, replace=False):
        out = write(self, table, rows, replace)
        if table == at:
            raise OSError("lost")
        return out

    with monkeypatch.context() as m:
        m.setattr(snapshots.Commit, "write", broken)
        m.setattr(snapshots.Commit, "publish", (lambda self: (_ for _ in ()).throw(OSError("lost"))) if at == "manifest" else publish)
        with pytest.raises(OSError):
            imports.import_documents(spark, root, two, "t2")
    assert state(spark, root) == before and snapshots.last_version(spark, root) == 1
    imports.import_documents(spark, root, two, "t3")
    after = state(spark, root)
    assert {t: len(rows) for t, rows in after.items()} == {"documents": 2, "changes": 3, "pids": 2, "places": 2}


def test_versions_stay_readable_and_are_taken_once(spark, tmp_path):
    root = str(tmp_path / "s")
    rows = lambda *n: spark.createDataFrame([(x,) for x in n], "n int")
    read = lambda table, version=None: sorted(r["n"] for r in snapshots.read(spark, root, table, "n int", version).collect())
    assert read("x") == [] and snapshots.last_version(spark, root) == 0

    def both(commit):
        commit.write("x", rows(1, 2))
        commit.write("y", rows(5))
        return True

    assert snapshots.committed(spark, root, both) == 1
    assert snapshots.committed(spark, root, lambda c: bool(c.write("x", rows(9), replace=True))) == 2
    assert snapshots.committed(spark, root, lambda c: not c.write("x", rows(7))) == 2
    assert (read("x"), read("x", 1), read("y"), read("y", 2)) == ([9], [1, 2], [5], [5])
    late, early = snapshots.Commit(spark, root), snapshots.Commit(spark, root)
    early.write("x", rows(3))
    late.write("x", rows(4))
    assert early.publish() == 3
    with pytest.raises(AnalysisException):
        late.publish()
    assert read("x") == [3, 9]


def test_states_at_a_time_by_brute_force(spark):
    rng = random.Random(6)
    log = [(rng.choice(["a", "b", None]) if rng.random() < 0.2 else "hot", rng.randrange(60) if rng.random() < 0.95 else None, i, rng.choice("xyz"), rng.random() < 0.2) for i in range(400)]
    asked = [(i, rng.choice(["a", "b", "hot", "none", None]), rng.randrange(-5, 70) if rng.random() < 0.9 else None) for i in range(200)]
    day = lambda c: F.timestamp_seconds(F.col(c) * 86400)
    table = spark.createDataFrame(log, LOG).withColumn("t", day("t")).repartition(3)
    questions = spark.createDataFrame(asked, "q int, id string, at int").withColumn("at", day("at")).repartition(2)
    last = lambda key, at: max(((r[1], r[2], r) for r in log if key is not None and r[0] == key and at is not None and r[1] is not None and r[1] <= at), default=None)
    for grain in ("day", "month", "year"):
        got = {r["q"]: r["change"] and r["change"]["seq"] for r in history.as_of(questions, table, "id", "at", "t", "seq", grain).collect()}
        assert got == {q: (found := last(key, at)) and found[1] for q, key, at in asked}
    alive = lambda at: {k: r[2][3] for k in ("a", "b", "hot") if (r := last(k, at)) and not r[2][4]}
    for at in (-1, 0, 20, 45, 59):
        moment = F.timestamp_seconds(F.lit(at * 86400))
        known = table.where("id is not null")
        assert {r["id"]: r["v"] for r in history.state_at(known, "id", "t", "seq", moment, F.col("gone")).collect()} == alive(at)
        back = {r["id"]: (r["v"], r["action"]) for r in history.roll_back_to(known, "id", "t", "seq", "v", moment, F.col("gone")).collect()}
        then, now = alive(at), alive(60)
        want = {k: (then.get(k), "restore" if k in then else "delete") for k in then.keys() | now.keys() if then.get(k) != now.get(k)}
        assert back == want
        # the appended changes lead back to the state of then
        more = [(k, 61, 1000 + i, v, action == "delete") for i, (k, (v, action)) in enumerate(back.items())]
        longer = known.unionByName(spark.createDataFrame(more, LOG).withColumn("t", day("t")))
        assert {r["id"]: r["v"] for r in history.state_at(longer, "id", "t", "seq", F.timestamp_seconds(F.lit(99 * 86400)), F.col("gone")).collect()} == then
    held = history.intervals(table.where("id = 'a' and t is not null"), "id", "t", "seq").orderBy("t", "seq").collect()
    assert [r["valid_to"] for r in held[:-1]] == [r["valid_from"] for r in held[1:]] and held[-1]["valid_to"] is None
    assert history.as_of(questions.limit(0), table, "id", "at", "t", "seq").count() == 0
    assert history.roll_back_to(table.limit(0), "id", "t", "seq", "v", F.current_timestamp(), F.col("gone")).count() == 0
