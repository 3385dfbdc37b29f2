"""The stored login state, the windows with corrections and the keyed logins, step by step."""

import datetime as dt
import json
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from checks.logs import spark_lines
from touchpath import jobs, state
from touchpath.plans import app, pages, pc
from touchpath.sources import logs, tables
from touchpath.streaming.hourly import HOUR_MS, news_of_visits, news_visits, stream_log
from touchpath.streaming.logins import earliest_logins, login_table, store_updates
from touchpath.streaming.windows import NewsWindows, news_windows

SF_DIR = "/root/testdata/sf0.001"
PAGE = "10010002000033"


def at(day):
    return dt.datetime(2024, 1, day)


def firsts(spark, *rows):
    return spark.createDataFrame(rows, "deviceid string, custno string, chuxuguan_firsttime timestamp, zhangji_firsttime timestamp, flag int")


def stored(spark, root):
    return {(r["deviceid"], r["custno"]): (r["chuxuguan_firsttime"], r["zhangji_firsttime"], r["flag"]) for r in state.read(spark, root).collect()}


def test_state_merges_once_per_batch_and_rewrites_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "state")
    many = [(f"d{i}", "0", at(2), None, 1) for i in range(50)]
    first = state.merge(spark, root, firsts(spark, *many), "monday", buckets=8)
    assert first.number == 1 and set(first.folders) == {str(b) for b in range(8)}
    second = state.merge(spark, root, firsts(spark, ("d7", "0", at(1), at(3), 2), ("new", "9", None, at(3), 2)), "tuesday")
    held = stored(spark, root)
    assert held[("d7", "0")] == (at(2), at(3), 2)  # stored times win
    assert held[("new", "9")] == (None, at(3), 2) and len(held) == 51
    moved = {b for b in second.folders if second.folders[b] != first.folders[b]}
    assert 1 <= len(moved) <= 2
    assert state.merge(spark, root, firsts(spark, ("d7", "0", at(1), at(1), 1)), "tuesday") == second
    assert stored(spark, root) == held
    assert state.read(spark, root, first).count() == 50  # the version before can still be read
    assert state.merge(spark, root, firsts(spark), "an empty day").number == 3


def test_a_run_that_fails_or_is_overtaken_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "state")
    state.merge(spark, root, firsts(spark, ("a", "0", at(2), None, 1)), "one")
    held = stored(spark, root)
    publish = state._Files.publish
    monkeypatch.setattr(state._Files, "publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        state.merge(spark, root, firsts(spark, ("a", "0", None, at(3), 2)), "two")
    assert stored(spark, root) == held

    def overtaken(files, name, text):
        publish(files, name, json.dumps(json.loads(text) | {"batches": ["one", "other"], "folders": state.current(spark, root).folders}))
        publish(files, name, text)
    monkeypatch.setattr(state._Files, "publish", overtaken)
    with pytest.raises(RuntimeError, match="another run"):
        state.merge(spark, root, firsts(spark, ("a", "0", None, at(3), 2)), "two")
    assert stored(spark, root) == held and state.current(spark, root).batches == ("one", "other")
    monkeypatch.setattr(state._Files, "publish", publish)
    assert state.merge(spark, root, firsts(spark, ("a", "0", None, at(3), 2)), "two").number == 3
    assert stored(spark, root) == {("a", "0"): (at(2), at(3), 2)}


def test_login_state_job_may_be_repeated(spark, tmp_path):
    spark_lines(spark, SF_DIR, "app_log").select("value").write.text(str(tmp_path / "in"))
    run = partial(jobs.app_login_state, spark, str(tmp_path / "in"), str(tmp_path / "state"))
    outcomes = []
    keep = lambda rows, log: outcomes.append({r["reason"]: r["n"] for r in rows.collect()})
    assert run("day", rejects=keep).number == run("day", rejects=keep).number == 1
    rows = logs.read_log(spark, str(tmp_path / "in"), logs.APP_LOGIN)
    assert outcomes == [{r["reason"]: r["n"] for r in app.rejects(rows).collect()}]
    assert state.read(spark, str(tmp_path / "state")).count() == app.first_logins(app.logins(rows)).count()


def line(guid, ms, page=PAGE):
    fields = [""] * 27
    fields[0], fields[1], fields[18] = guid, str(ms), page
    return "\u0001".join(fields)


def run_windows(spark, folder, name, per_trigger=None):
    options = {"maxFilesPerTrigger": str(per_trigger)} if per_trigger else {}
    windows = NewsWindows(spark, f"{folder}/{name}")
    rows = stream_log(spark, f"{folder}/in", logs.PAGE_VIEW, **options)
    job = news_windows(rows, windows).option("checkpointLocation", f"{folder}/{name}-progress").trigger(availableNow=True)
    job.start().awaitTermination()
    return windows


def counts(df):
    return {(r["hour_ms"], r["page_id"]): (r["pv"], r["uv"]) for r in df.collect()}


def test_an_hour_is_reported_once_and_late_rows_correct_it(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1").write_text("\n".join(line(g, t) for g, t in [("0xa", 1), ("0xa", 2), ("0xb", 3), ("0xa", HOUR_MS + 1)]))
    windows = run_windows(spark, str(tmp_path), "w")
    assert counts(windows.reported()) == {} and counts(windows.still_open()) == {(0, PAGE): (3, 2), (HOUR_MS, PAGE): (1, 1)}
    (source / "2").write_text("\n".join([line("0xc", 2 * HOUR_MS), line("0xd", 5)]))  # the mark is one hour still
    run_windows(spark, str(tmp_path), "w")
    (source / "3").write_text("\n".join([line("0xa", 7), line("0xe", 8), line("0xe", 9), line("0xz", 3 * HOUR_MS)]))
    windows = run_windows(spark, str(tmp_path), "w")
    first = counts(windows.reported())
    assert first == {(0, PAGE): (4, 3)}
    assert counts(windows.corrections()) == {(0, PAGE): (3, 1)}  # 0xa was counted, 0xe was not
    (source / "4").write_text("\n".join([line("0xe", 10), line("0xf", 11), line("0xf", 9 * HOUR_MS)]))
    windows = run_windows(spark, str(tmp_path), "w")
    assert first.items() <= counts(windows.reported()).items()  # what was reported stays
    assert sorted(counts(windows.totals())) == [(h * HOUR_MS, PAGE) for h in (0, 1, 2, 3, 9)]
    assert counts(windows.totals())[(0, PAGE)] == (9, 5)


@pytest.mark.parametrize("per_trigger", [1, 2, None])
def test_windows_and_corrections_are_the_counts_of_all_rows(spark, tmp_path, per_trigger):
    rng = random.Random(4)
    (tmp_path / "in").mkdir()
    for i in range(5):
        made = [line(f"0x{rng.randrange(30)}", (i - rng.choice([0, 0, 1, 3])) * HOUR_MS + rng.randrange(HOUR_MS), rng.choice([PAGE, "9" + PAGE]))
                for _ in range(200)]
        made += [line("0x1", "9" * 18)]  # no time that can be read
        (tmp_path / "in" / f"{i}").write_text("\n".join(made))
    windows = run_windows(spark, str(tmp_path), "w", per_trigger)
    rows = logs.read_log(spark, str(tmp_path / "in"), logs.PAGE_VIEW)
    assert counts(windows.totals()) == counts(news_of_visits(news_visits(rows)))
    if per_trigger == 1:
        assert windows.reported().count() and windows.corrections().count()


def test_keyed_logins_do_not_depend_on_batches(spark, tmp_path):
    spark_lines(spark, SF_DIR, "app_log").select("value").repartition(4).write.text(str(tmp_path / "in"))
    results = []
    for n, options in enumerate(({"maxFilesPerTrigger": "1"}, {})):
        rows = stream_log(spark, str(tmp_path / "in"), logs.APP_LOGIN, **options)
        out = str(tmp_path / f"out{n}")
        store_updates(earliest_logins(rows), out).option("checkpointLocation", f"{out}-progress").trigger(
            availableNow=True).start().awaitTermination()
        results.append(sorted(map(tuple, login_table(spark, out).collect())))
    batch = app.first_logins(app.logins(logs.read_log(spark, str(tmp_path / "in"), logs.APP_LOGIN)))
    want = sorted(map(tuple, batch.select("deviceid", "custno", "chuxuguan_firsttime", "zhangji_firsttime", "flag").collect()), key=repr)
    assert sorted(results[0], key=repr) == sorted(results[1], key=repr) == want


def test_keyed_logins_are_summed_up_before_they_meet_the_state(spark, tmp_path):
    (tmp_path / "in").mkdir()
    def login(proid, ts, custno="0"):
        fields = {0: str(ts), 1: proid, 2: "imei1", 3: "idfa1", 5: "1", 6: custno}
        return "\u0001".join(fields.get(i, "") for i in range(logs.APP_LOGIN.arity))
    for name, lines in (("1", [login("2001", 5000 + i % 7) for i in range(3000)] + [login("3002", 9000, "7")]),
                        ("2", [login("3001", 8000), login("2001", 6000)] + [login("2002", 4000)] * 1000),
                        ("3", [login("2001", 9000), login("3001", 7500)])):
        (tmp_path / "in" / name).write_text("\n".join(lines))
        rows = stream_log(spark, str(tmp_path / "in"), logs.APP_LOGIN, maxFilesPerTrigger="1")
        updates = earliest_logins(rows)
        plan = updates._jdf.queryExecution().analyzed().toString()
        assert "Pandas" not in plan and "Python" not in plan
        job = store_updates(updates, str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "progress"))
        job.trigger(availableNow=True).start().awaitTermination()
    table = login_table(spark, str(tmp_path / "out"))
    times = [F.unix_millis(name) for name in ("chuxuguan_firsttime", "zhangji_firsttime")]
    got = sorted(tuple(r) for r in table.select("deviceid", "custno", *times, "flag").collect())
    assert got == [("idfa1", "0", 5000, 7500, 2), ("imei1", "0", 4000, None, 1), ("imei1", "7", None, 9000, 1)]


def test_a_day_written_again_replaces_itself_only(spark, tmp_path):
    rows = spark.createDataFrame([("10001", "0x1")], "tag string, guid string")
    def report(day, n):
        return rows.select(F.lit(day).cast("date").alias("dt"), "tag", F.lit("p").alias("proid"), F.lit("").alias("page_id"), F.lit(n).alias("click_num"))
    for day, n in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-01", 3)):
        tables.replace_days_parquet(report(day, n), "channel_ad_click", str(tmp_path))
    got = spark.read.parquet(str(tmp_path / "channel_ad_click")).collect()
    assert sorted((str(r["dt"]), r["click_num"]) for r in got) == [("2024-01-01", 3), ("2024-01-02", 2)]


def test_checked_rows_are_not_checked_again(spark):
    rows = spark.createDataFrame([("0x1", "5", "https://www.fundhub.com/", "1")], "guid string, ts string, desturl string, proid string")
    checked = pc.check(rows)
    assert pc.check(checked) is checked
    assert pages.check_news(checked) is checked


def test_page_ids_of_25_digits_stay_apart(spark):
    ids = ["9" * 23 + "12", "9" * 22 + "812"]
    rows = spark.createDataFrame([("0x1", "5", "https://simu.fundhub.com/p", "1", i) for i in ids], "guid string, ts string, desturl string, proid string, pageid string")
    assert {int(r["page_id"]) for r in pages.private_fund_report(rows).collect()} == {int(i) for i in ids}
