"""Streams against batches: state across restarts, late rows, and the jobs end to end."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_operators import jumps_by_hand, log_row

from tidemart import schemas as S
from tidemart.functions import text
from tidemart.functions.times import with_event_time
from tidemart.operators import logs, stats
from tidemart.plans.layers import Layers
from tidemart.plans.registry import FAR_MS
from tidemart.sinks import dimensions, topics
from tidemart.sinks.stats import read_stats
from tidemart.sources import driver_tables as D
from tidemart.sources.topics import read_topic
from tidemart.streaming import runs, stateful
from tidemart.streaming.jobs import Jobs

PAGE_SCHEMA = S.log_schema()
PAGES = [f for f in PAGE_SCHEMA.fieldNames() if f != "start"]


def slices(spark, folder, schema, parts, build):
    """Feed row lists one restart at a time; rows of the query's output so far after each."""
    stream = spark.readStream.schema(schema).parquet(f"{folder}/in/part=*").drop("part")
    query = None
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in/part={i}")
        query = runs.checkpointed_run(build(stream), f"{folder}/out", f"{folder}/checkpoint", runs.NOW)
        query.awaitTermination()
    return spark.read.parquet(f"{folder}/out"), query


def settled(spark, folder, parts, run):
    """The same for an operator that hands on its micro-batches."""
    stream = spark.readStream.schema(PAGE_SCHEMA).parquet(f"{folder}/in/part=*").drop("part")
    for i, part in enumerate(parts):
        spark.createDataFrame(part, PAGE_SCHEMA).coalesce(1).write.parquet(f"{folder}/in/part={i}")
        run(
            stream, lambda df, batch: df.write.mode("overwrite").parquet(f"{folder}/out/batch={batch}"),
            f"{folder}/checkpoint", runs.NOW,
        ).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def in_parts(rows, n):
    rows = sorted(rows, key=lambda r: r.ts)
    size = len(rows) // n + 1
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def test_fix_is_new_across_restarts(spark, tmp_path):
    rng = random.Random(1)
    rows = [log_row(rng.choice("abcd"), t, is_new=rng.choice("01")) for t in rng.sample(range(10_000), 60)]
    out = settled(spark, str(tmp_path), in_parts(rows, 3), stateful.fix_is_new_stream)
    want = logs.fix_is_new(spark.createDataFrame(rows, PAGE_SCHEMA))
    cols = ["common.mid", "ts", "common.is_new"]
    assert sorted(out.select(cols).collect()) == sorted(want.select(cols).collect())


def test_user_jump_across_restarts_out_of_order(spark, tmp_path):
    """Rows up to 2 s out of order within and between slices still give the batch answer."""
    rng = random.Random(2)
    used = rng.sample(range(0, 400_000, 250), 200)
    rows = [(rng.choice(["hot", "hot", "b"]), t, rng.random() < 0.5) for t in used]
    made = [log_row(m, t, last=None if e else "home") for m, t, e in rows]
    made.sort(key=lambda r: r.ts + rng.randrange(1_900))
    parts = [made[i:i + 50] for i in range(0, len(made), 50)] + [[log_row("end", FAR_MS)]]
    out, _ = slices(
        spark, str(tmp_path), PAGE_SCHEMA, parts,
        lambda df: stateful.user_jump_stream(df.drop("start"), slot_ms=25_000),
    )
    got = sorted((r.mid, r.ts) for r in out.select("common.mid", "ts").collect())
    assert [g for g in got if g[0] != "end"] == jumps_by_hand(rows, 10_000)


def test_unique_visit_across_restarts(spark, tmp_path):
    rng = random.Random(3)
    used = rng.sample(range(0, 3 * 86_400_000, 1_000), 200)
    rows = [log_row(rng.choice("abc"), t, last=rng.choice([None, "home"])) for t in used]
    out = settled(spark, str(tmp_path), in_parts(rows, 4), stateful.unique_visit_stream)
    want = logs.unique_visit(spark.createDataFrame(rows, PAGE_SCHEMA))
    assert sorted(out.select("common.mid", "ts").collect()) == sorted(want.select("common.mid", "ts").collect())


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    parts = [[log_row("a", 100_000)], [log_row("a", 200_000)], [log_row("a", 100_500), log_row("a", 199_900)], [log_row("a", FAR_MS)]]

    def counted(df):
        return stats.page_area_counts(with_event_time(df, "ts", "2 seconds"))

    folder, stream_schema = str(tmp_path), PAGE_SCHEMA
    stream = spark.readStream.schema(stream_schema).parquet(f"{folder}/in/part=*").drop("part")
    watched = runs.watch_late(spark)
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, PAGE_SCHEMA).coalesce(1).write.parquet(f"{folder}/in/part={i}")
        query = runs.checkpointed_run(counted(stream), f"{folder}/out", f"{folder}/checkpoint", runs.NOW)
        query.awaitTermination()
    lost = watched.of(query)
    spark.streams.removeListener(watched)
    out = spark.read.parquet(f"{folder}/out")
    assert sorted((r.stt[-8:], r.order_count) for r in out.collect()) == [("00:01:40", 1), ("00:03:10", 1), ("00:03:20", 1)]
    assert lost == 1


def close(spark, uri, topic, rows, ms="ts"):
    """Append a far-future record to a topic, so that every window before it closes."""
    topics.write_topic(text.to_value(rows.limit(1).withColumn(ms, F.lit(FAR_MS))), uri, topic)


@pytest.fixture(scope="module")
def jobs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    return Jobs(spark, f"{root}/topics", f"{root}/dims", f"{root}/stats", f"{root}/checkpoints", runs.NOW)


def done(query):
    query.awaitTermination()
    return query


def topic(jobs, name, schema):
    return text.parse_json(read_topic(jobs.spark, jobs.uri, name, stream=False), schema)


def rows(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_log_jobs(jobs, spark, small):
    """Raw log in three deliveries -> start, page, display -> visits and jumps -> visitor statistics."""
    log = D.base_log(spark, small)
    bounds = log.agg(F.min("ts"), F.max("ts")).first()
    step = (bounds[1] - bounds[0]) // 3 + 1
    for i in range(3):
        part = log.filter(F.floor((F.col("ts") - bounds[0]) / step) == i)
        topics.write_topic(text.to_value(part), jobs.uri, S.TOPIC_BASE_LOG)
        done(jobs.split_logs())
        done(jobs.unique_visits())
        done(jobs.user_jumps(within_ms=6 * 3_600_000))
    fixed = logs.fix_is_new(log)
    cols = ["common.mid", "common.is_new", "page.page_id", "page.item", "ts"]
    pages = logs.page_records(fixed)
    assert rows(topic(jobs, S.TOPIC_PAGE, S.LOG), *cols) == rows(pages, *cols)
    assert topic(jobs, S.TOPIC_START, S.LOG).count() == logs.start_records(fixed).count()
    assert topic(jobs, S.TOPIC_DISPLAY, S.LOG).count() == logs.display_records(fixed).count()
    assert rows(topic(jobs, S.TOPIC_UNIQUE_VISIT, S.LOG), "common.mid", "ts") == rows(logs.unique_visit(pages), "common.mid", "ts")

    end = log.filter("page IS NOT NULL").limit(1).withColumn("common", F.col("common").withField("mid", F.lit("end")))
    close(spark, jobs.uri, S.TOPIC_PAGE, end)
    done(jobs.user_jumps(within_ms=6 * 3_600_000))
    jumped = topic(jobs, S.TOPIC_USER_JUMP, S.LOG).filter(F.col("ts") < FAR_MS)
    assert rows(jumped, "common.mid", "ts") == rows(logs.user_jump(pages, 6 * 3_600_000), "common.mid", "ts")

    done(jobs.visitor_stats(width="1 hour"))
    from tidemart.operators import facts
    from tidemart.schemas import VISITOR_STATS

    facts_rows = facts.visitor_union(pages, logs.unique_visit(pages), logs.user_jump(pages, 6 * 3_600_000))
    want = stats.visitor_stats(with_event_time(facts_rows), "1 hour")
    names = [f.name for f in VISITOR_STATS.fields]
    assert rows(read_stats(spark, f"{jobs.stats_root}/visitor_stats"), *names) == rows(want, *names)


def test_order_jobs(jobs, spark, small):
    """Orders, lines and payments -> wide tables -> product and province statistics."""
    day = 86_400_000
    for name, dim in D.dimensions(spark, small).items():
        dimensions.ensure_dim_table(spark, jobs.dims_root, name, ",".join(dim.columns))
        records = dim.select(
            F.lit("insert").alias("type"), F.lit("1").alias("ts_ms"),
            F.map_from_arrays(F.array([F.lit(c) for c in dim.columns]), F.array(dim.columns)).alias("after"),
        )
        dimensions.upsert_dim(records, jobs.dims_root, name, ",".join(dim.columns))
        assert rows(dimensions.read_dim(spark, jobs.dims_root, name), *dim.columns) == rows(dim, *dim.columns)
    layers = Layers(spark, small)
    for name, df in {
        S.TOPIC_ORDER_INFO: D.order_info(spark, small), S.TOPIC_ORDER_DETAIL: D.order_detail(spark, small),
        S.TOPIC_PAYMENT: D.payment_info(spark, small), S.TOPIC_FAVOR: D.favor_info(spark, small),
        S.TOPIC_CART: D.cart_info(spark, small), S.TOPIC_REFUND: D.refund_info(spark, small),
        S.TOPIC_COMMENT: D.comment_info(spark, small),
    }.items():
        topics.write_topic(text.to_value(df), jobs.uri, name)
    done(jobs.order_wide(30 * day, 30 * day))
    wide = layers.order_wide_full()
    got = text.parse_record(read_topic(spark, jobs.uri, S.TOPIC_ORDER_WIDE, stream=False), S.ORDER_WIDE)
    cols = ["order_id", "detail_id", "sku_id", "split_total_amount", "create_time", *S.ORDER_WIDE_DIMS]
    assert rows(got, *cols) == rows(wide, *cols)

    done(jobs.payment_wide())
    paid = text.parse_record(read_topic(spark, jobs.uri, S.TOPIC_PAYMENT_WIDE, stream=False), S.PAYMENT_WIDE)
    assert rows(paid, *S.PAYMENT_WIDE.fieldNames()) == rows(layers.payment_wide(), *S.PAYMENT_WIDE.fieldNames())

    close(spark, jobs.uri, S.TOPIC_CART, D.cart_info(spark, small), "create_time")
    close(spark, jobs.uri, S.TOPIC_ORDER_WIDE, wide, "create_time")
    done(jobs.province_stats("30 days"))
    names = ["province_id", "stt", "edt", "order_amount", "order_count", "ts"]
    want = Layers(spark, small, width="30 days").province_stats()
    closed = read_stats(spark, f"{jobs.stats_root}/province_stats").filter("stt < '2099'")
    assert rows(closed, *names) == rows(want, *names)


def test_router_job(jobs, spark, small):
    """Captured changes and rules -> topics and dimension tables, in two deliveries."""
    records = D.change_records(spark, small)
    topics.write_topic(D.rule_records(spark, small), jobs.uri, "rules")
    for kind in ['"op":"c"', '"op":"']:
        part = records.filter(F.col("value").contains(kind) & ((F.lit(kind) != '"op":"') | ~F.col("value").contains('"op":"c"')))
        topics.write_topic(part, jobs.uri, "captured")
        done(jobs.changes("captured"))
        done(jobs.route("rules"))
    routed = Layers(spark, small).routed().persist()
    sent = spark.read.option("basePath", jobs.uri).text(f"{jobs.uri}/topic=sink_*")
    want = topics.topic_rows(routed.filter(F.col("sink_type") == S.SINK_TOPIC))
    assert rows(sent, "topic", "value") == rows(want, "topic", "value")
    in_dims = routed.filter(F.col("sink_type") == S.SINK_DIMENSION)
    for name in [r.sink_table for r in in_dims.select("sink_table").distinct().collect()]:
        mine = in_dims.filter(F.col("sink_table") == name)
        table = dimensions.read_dim(spark, jobs.dims_root, name)
        assert table.count() == mine.select(F.col("after")["id"]).distinct().count()


def test_keyword_and_product_jobs(jobs, spark, small):
    uri_jobs = Jobs(
        spark, f"{jobs.uri}-2", jobs.dims_root, f"{jobs.stats_root}-2", f"{jobs.checkpoints}-2", runs.NOW
    )
    searches = D.search_log(spark, small)
    topics.write_topic(text.to_value(searches), uri_jobs.uri, S.TOPIC_PAGE)
    close(spark, uri_jobs.uri, S.TOPIC_PAGE, searches)
    done(uri_jobs.keyword_stats())
    want = Layers(spark, small).keyword_stats()
    names = want.columns
    got = read_stats(spark, f"{uri_jobs.stats_root}/keyword_stats").filter("stt < '2099'")
    assert rows(got, *names) == rows(want, *names)


def test_product_job(jobs, spark, small):
    """Runs on the topics the order jobs wrote, with the pages of the plain log."""
    folder = f"{jobs.uri}-3"
    mine = Jobs(spark, folder, jobs.dims_root, f"{jobs.stats_root}-3", f"{jobs.checkpoints}-3", runs.NOW)
    layers = Layers(spark, small)
    inputs = {
        S.TOPIC_PAGE: layers.pages(), S.TOPIC_FAVOR: D.favor_info(spark, small), S.TOPIC_CART: D.cart_info(spark, small),
        S.TOPIC_ORDER_WIDE: layers.order_wide_full(), S.TOPIC_PAYMENT_WIDE: layers.payment_wide(),
        S.TOPIC_REFUND: D.refund_info(spark, small), S.TOPIC_COMMENT: D.comment_info(spark, small),
    }
    for name, df in inputs.items():
        topics.write_topic(text.to_value(df), folder, name)
    close(spark, folder, S.TOPIC_CART, D.cart_info(spark, small), "create_time")
    done(mine.product_stats("1 hour"))
    want = Layers(spark, small, width="1 hour").product_stats()
    got = read_stats(spark, f"{mine.stats_root}/product_stats").filter("stt < '2099'")
    names = want.columns
    assert rows(got, *names) == rows(want, *names)


def test_reader_may_start_before_its_writer(spark, tmp_path):
    uri = str(tmp_path)
    done(runs.passthrough(spark, uri, "a", "b", f"{uri}/checkpoint", runs.NOW))
    topics.write_topic(spark.createDataFrame([("x",), ("y",)], "value string"), uri, "a")
    done(runs.passthrough(spark, uri, "a", "b", f"{uri}/checkpoint", runs.NOW))
    done(runs.passthrough(spark, uri, "a", "b", f"{uri}/checkpoint", runs.NOW))
    assert sorted(r.value for r in spark.read.text(f"{uri}/topic=b").collect()) == ["x", "y"]


def test_console(spark, tmp_path, capsys):
    from tidemart.sinks.stats import write_console

    rows_in = spark.createDataFrame([("shown",)], "value string")
    write_console(rows_in, "batch")
    assert "shown" in capsys.readouterr().out
    topics.write_topic(rows_in, str(tmp_path), "t")
    query = write_console(read_topic(spark, str(tmp_path), "t"), "printed", f"{tmp_path}/checkpoint")
    query.processAllAvailable()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    query.stop()


def test_hot_device_on_streams(spark, tmp_path):
    """One device with a third of all rows: the batch answer, from groups of bounded size."""
    rng = random.Random(5)
    times = rng.sample(range(0, 600_000), 1500)
    rows_in = [("hot" if i % 3 == 0 else f"d{rng.randrange(40)}", t, rng.random() < 0.6) for i, t in enumerate(times)]
    made = sorted((log_row(m, t, last=None if e else "home") for m, t, e in rows_in), key=lambda r: r.ts)
    parts = [made[:700], made[700:], [log_row("end", FAR_MS)]]
    out, query = slices(spark, str(tmp_path), PAGE_SCHEMA, parts, lambda df: stateful.user_jump_stream(df.drop("start"), kind=True))
    got = sorted((r.mid, r.ts) for r in out.select("common.mid", "ts").collect())
    assert [g for g in got if g[0] != "end"] == jumps_by_hand(rows_in, 10_000)
    want = logs.user_jump(spark.createDataFrame(made, PAGE_SCHEMA).drop("start"), kind=True)
    cols = ["common.mid", "ts", "kind"]
    assert rows(out.filter("common.mid != 'end'"), *cols) == rows(want, *cols)
    hot = sorted(t for m, t, _ in rows_in if m == "hot")
    per_step = max(sum(1 for t in hot if s <= t < s + 1250) for s in range(0, 600_000, 1250))
    assert per_step < len(hot) / 30


@pytest.mark.parametrize("within", [8_000, 7, 1, 11])
def test_jump_steps_of_any_length(spark, tmp_path, within):
    rng = random.Random(within)
    times = rng.sample(range(0, 60 * max(within, 20)), 300)
    rows_in = [(rng.choice("ab"), t, rng.random() < 0.5) for t in times]
    made = sorted((log_row(m, t, last=None if e else "home") for m, t, e in rows_in), key=lambda r: r.ts)
    out, _ = slices(
        spark, str(tmp_path), PAGE_SCHEMA, [made, [log_row("end", FAR_MS)]],
        lambda df: stateful.user_jump_stream(df.drop("start"), within, slot_ms=3 * within + 1),
    )
    got = sorted((r.mid, r.ts) for r in out.select("common.mid", "ts").collect())
    assert [g for g in got if g[0] != "end"] == jumps_by_hand(rows_in, within)


def test_late_rows_over_many_batches(spark, tmp_path):
    """More batches than a query remembers; a second query's rows are its own."""
    folder, n = str(tmp_path), 104
    for name in ("in", "other"):
        (tmp_path / name).mkdir()
    for i in range(n):
        times = [100_000 + i * 1_000] + [1_000] * (i >= 5)
        (tmp_path / f"in/{i:03d}.json").write_text("".join(f'{{"common":{{"mid":"m"}},"ts":{t}}}\n' for t in times))
    (tmp_path / "other/0.json").write_text('{"common":{"mid":"m"},"ts":1}\n')
    watched = runs.watch_late(spark)
    queries = []
    for name, source in (("many", "in"), ("one", "other")):
        stream = spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{folder}/{source}")
        counted = stats.page_area_counts(with_event_time(stream, "ts", "2 seconds"))
        queries.append(done(runs.checkpointed_run(counted, f"{folder}/{name}", f"{folder}/{name}-checkpoint", runs.NOW)))
    lost = [watched.of(q) for q in queries]
    spark.streams.removeListener(watched)
    assert watched.batches[str(queries[0].id)] > 100 and len(queries[0].recentProgress) <= 100
    assert lost == [n - 5, 0]


def test_unreadable_lines_job(spark, small, tmp_path):
    """Bad lines in the topics of changes, rules, orders and payments: none passed on as null rows, all found and counted."""
    uri = str(tmp_path)
    mine = Jobs(spark, f"{uri}/topics", f"{uri}/dims", f"{uri}/stats", f"{uri}/checkpoints", runs.NOW)
    bad = spark.createDataFrame([("{cut",), ("",), ("[]",), ('{"other":1}',)], "value string")
    order = {"id": 1, "user_id": 2, "create_time": 1000, "province_id": 3}
    line = {"id": 11, "order_id": 1, "sku_id": 5, "create_time": 1500, "split_total_amount": "2.50"}
    payment = {"id": 7, "order_id": 1, "create_time": 2000}
    record = {"source": {"db": "d", "table": "t"}, "op": "c", "ts_ms": "1", "after": {"id": "1", "x": "y"}}
    rule = {"source": {"db": "d", "table": "rules"}, "op": "c", "ts_ms": "1", "after": {
        "source_table": "t", "operate_type": "insert", "sink_type": "kafka", "sink_table": "sunk", "sink_columns": "id,x"}}
    good = {"captured": record, "rules": rule, S.TOPIC_ORDER_INFO: order, S.TOPIC_ORDER_DETAIL: line, S.TOPIC_PAYMENT: payment}
    import json

    for name, value in good.items():
        topics.write_topic(spark.createDataFrame([(json.dumps(value),)], "value string").unionAll(bad), mine.uri, name)
    for _ in range(2):
        done(mine.unreadable("captured", "rules"))
    found = {r.topic: r["lines"] for r in mine.unreadable_counts().collect()}
    # a change without fields is still a change; an order without id or time is of no use
    assert found == {"captured": 3, "rules": 3, S.TOPIC_ORDER_INFO: 4, S.TOPIC_ORDER_DETAIL: 4, S.TOPIC_PAYMENT: 4}
    done(mine.changes("captured"))
    done(mine.route("rules"))
    assert [r.value for r in spark.read.text(f"{mine.uri}/topic=sunk").collect()] == ['{"id":"1","x":"y"}']
    done(mine.order_wide())
    done(mine.payment_wide())
    wide = text.parse_record(read_topic(spark, mine.uri, S.TOPIC_ORDER_WIDE, stream=False), S.ORDER_WIDE).collect()
    paid = text.parse_record(read_topic(spark, mine.uri, S.TOPIC_PAYMENT_WIDE, stream=False), S.PAYMENT_WIDE).collect()
    assert [(r.order_id, r.detail_id) for r in wide] == [(1, 11)] and [(r.payment_id, r.detail_id) for r in paid] == [(7, 11)]


def rule_line(spark, ts, sink, operation="insert"):
    import json

    after = {"source_table": "t", "operate_type": operation, "sink_type": "kafka", "sink_table": sink, "sink_columns": "id"}
    record = {"source": {"db": "c", "table": "rules"}, "op": "c", "ts_ms": str(ts), "after": after}
    return spark.createDataFrame([(json.dumps(record),)], "value string")


def change_line(spark, *ids):
    values = [(f'{{"database":"d","table":"t","type":"insert","ts_ms":"{i}","after":{{"id":"{i}"}}}}',) for i in ids]
    return spark.createDataFrame(values, "value string")


def test_rules_are_kept_not_read_again(spark, tmp_path):
    uri = str(tmp_path)

    def job(checkpoint="one"):
        return Jobs(spark, f"{uri}/topics", f"{uri}/dims", f"{uri}/stats", f"{uri}/{checkpoint}", runs.NOW)

    mine = job()
    topics.write_topic(rule_line(spark, 5, "first"), mine.uri, "rules")
    topics.write_topic(change_line(spark, 1), mine.uri, S.TOPIC_BASE_DB)
    done(mine.route("rules"))
    topics.write_topic(rule_line(spark, 9, "second"), mine.uri, "rules")  # came later, does not count
    topics.write_topic(rule_line(spark, 9, "updates", "update"), mine.uri, "rules")
    topics.write_topic(change_line(spark, 2), mine.uri, S.TOPIC_BASE_DB)
    done(mine.route("rules"))
    files = len(list(tmp_path.glob("dims/ROUTING_RULES/*.parquet")))
    topics.write_topic(change_line(spark, 3), mine.uri, S.TOPIC_BASE_DB)
    query = done(mine.route("rules"))
    assert sum(p["numInputRows"] for p in query.recentProgress) < 4 * 3  # the one change, however often the batch is read
    assert all("topic=rules" not in s["description"] or s["numInputRows"] == 0 for p in query.recentProgress for s in p["sources"])
    assert len(list(tmp_path.glob("dims/ROUTING_RULES/*.parquet"))) == files
    topics.write_topic(change_line(spark, 4), mine.uri, S.TOPIC_BASE_DB)
    done(job("two").route("rules"))  # a new checkpoint reads the topics anew
    sent = sorted(r.value for r in spark.read.text(f"{uri}/topics/topic=first").collect())
    assert sent == sorted(f'{{"id":"{i}"}}' for i in (1, 2, 3, 1, 2, 3, 4))
    assert not list(tmp_path.glob("topics/topic=second"))


def test_order_slices_follow_the_number_of_orders(spark, small, monkeypatch):
    """a slice, and so the state of its run, holds a bounded number of orders; only two batches' state is kept."""
    from tidemart.plans import registry

    asked, began, start = [], [], runs.checkpointed_run
    feed = registry.Feed.__init__

    def noted(self, *args, **kwargs):
        feed(self, *args, **kwargs)
        asked.append(self)

    def run(df, path, checkpoint, *args):
        began.append((checkpoint, {key: spark.conf.get(key) for key in registry.JOIN_STATE}))
        return start(df, path, checkpoint, *args)

    monkeypatch.setattr(registry.Feed, "__init__", noted)
    monkeypatch.setattr(registry.runs, "checkpointed_run", run)
    orders = spark.read.parquet(f"{small}/orders.parquet").count()
    monkeypatch.setattr(registry, "SLICE_ORDERS", -(-orders // 5))
    before = {key: spark.conf.get(key, None) for key in registry.JOIN_STATE}
    got = registry.QUERIES["order_wide_stream"](spark, small)
    layers = Layers(spark, small)
    want = layers.order_wide().select(registry.ORDER_WIDE_OUT)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert asked[0].slices == 5 and len(asked[0].cuts) == 4 and len(began) == 6
    assert {key: spark.conf.get(key, None) for key in registry.JOIN_STATE} == before
    assert all(held == registry.JOIN_STATE for _, held in began)
    first = min(int(p.name) for p in Path(began[0][0].removeprefix("file:"), "commits").iterdir() if p.name.isdigit())
    assert first > 0  # batches that no restart reads are gone
