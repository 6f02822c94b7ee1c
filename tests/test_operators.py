"""Edges of single operators on hand-made rows."""

import json
import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart import schemas as S
from tidemart.functions import text, times, tokens
from tidemart.operators import facts, joins, logs, reports, routing, stats
from tidemart.sinks import dimensions, topics
from tidemart.sinks.stats import compact_stats, read_stats, write_stats
from tidemart.sources import changes as C
from tidemart.sources import driver_tables as D
from tidemart.sources import tables as TB


def log_row(mid, ts, last=None, is_new="0", page="home", displays=(), start=False, item=None, item_type=None, during=1):
    return Row(
        common=Row(mid=mid, vc="1", ch="a", ar="9", is_new=is_new, area_code="9"),
        page=None if start else Row(page_id=page, last_page_id=last, item=item, item_type=item_type, during_time=during),
        start=Row(entry="icon", loading_time="3") if start else None,
        displays=[Row(item=i, item_type=t) for i, t in displays],
        ts=ts,
    )


def log(spark, *rows):
    return spark.createDataFrame(list(rows), S.LOG)


def pages(spark, *rows):
    return logs.page_records(log(spark, *rows))


def ts_of(df):
    return sorted(r.ts for r in df.select("ts").collect())


# ---- logs


def test_fix_is_new_first_claim_only(spark):
    df = log(
        spark, log_row("a", 5, is_new="1"), log_row("a", 3, is_new="1"), log_row("a", 1, is_new="0"),
        log_row("a", 86_400_000 * 3, is_new="1"), log_row("b", 9, is_new="1"),
    )
    out = {(r.mid, r.ts): r.is_new for r in logs.fix_is_new(df).select("common.mid", "ts", "common.is_new").collect()}
    assert out == {("a", 5): "0", ("a", 3): "1", ("a", 1): "0", ("a", 86_400_000 * 3): "0", ("b", 9): "1"}


def test_fix_is_new_equal_records_keep_one(spark):
    df = log(spark, *[log_row("a", 5, is_new="1") for _ in range(3)])
    assert sorted(r.is_new for r in logs.fix_is_new(df).select("common.is_new").collect()) == ["0", "0", "1"]


def test_unique_visit_first_entry_per_day(spark):
    day = 86_400_000
    df = pages(
        spark, log_row("a", 10), log_row("a", 20, last=""), log_row("a", 5, last="home"),
        log_row("a", day + 7), log_row("b", 11),
    )
    assert ts_of(logs.unique_visit(df)) == [10, 11, day + 7]


@pytest.mark.parametrize(
    "following,kept",
    [
        ([], [100]),                              # nothing follows
        ([(5_100, "home")], []),                  # a page of the visit follows in time
        ([(10_100, "home")], [100]),              # the bound itself is too late
        ([(10_099, "home")], []),
        ([(5_100, None)], [100, 5_100]),          # another entry page: both lead nowhere
        ([(5_100, None), (6_000, "home")], [100]),
    ],
)
def test_user_jump_cases(spark, following, kept):
    df = pages(spark, log_row("a", 100), *[log_row("a", t, last=p) for t, p in following])
    assert ts_of(logs.user_jump(df)) == kept


def jumps_by_hand(rows, within):
    out = []
    for mid in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == mid)
        for i, (_, ts, entry) in enumerate(mine):
            if not entry:
                continue
            nxt = mine[i + 1] if i + 1 < len(mine) else None
            if nxt is None or nxt[2] or nxt[1] - ts >= within:
                out.append((mid, ts))
    return sorted(out)


@pytest.mark.parametrize("slot", [10_000, 25_000, 80_000])
def test_user_jump_brute_force(spark, slot):
    rng = random.Random(slot)
    times_used = rng.sample(range(0, 600_000, 500), 300)
    rows = [(rng.choice(["hot", "hot", "b", "c"]), t, rng.random() < 0.5) for t in times_used]
    df = pages(spark, *[log_row(m, t, last=None if e else "home") for m, t, e in rows])
    got = sorted((r.mid, r.ts) for r in logs.user_jump(df, 10_000, slot).select("common.mid", "ts").collect())
    assert got == jumps_by_hand(rows, 10_000)


def test_split_log(spark):
    df = log(
        spark, log_row("a", 1, start=True), log_row("a", 2, displays=[("7", "sku_id"), ("8", "activity_id")]),
        log_row("a", 3),
    )
    parts = logs.split_log(df)
    assert ts_of(parts[S.TOPIC_START]) == [1]
    assert ts_of(parts[S.TOPIC_PAGE]) == [2, 3]
    shown = parts[S.TOPIC_DISPLAY].collect()
    assert sorted((r.item, r.mid, r.page_id) for r in shown) == [("7", "a", "home"), ("8", "a", "home")]
    whole = logs.split_log(df, whole_record=True)[S.TOPIC_DISPLAY]
    assert whole.columns == parts[S.TOPIC_PAGE].columns and ts_of(whole) == [2, 2]


@pytest.mark.parametrize("whole", [False, True])
def test_log_topics_equal_the_split(spark, whole):
    df = log(
        spark, log_row("a", 1, start=True), log_row("a", 2, displays=[("7", "sku_id"), ("8", "activity_id")]), log_row("a", 3),
    )
    got = sorted(tuple(r) for r in logs.log_topics(df, whole).collect())
    want = [
        (t, r.value) for t, part in logs.split_log(df, whole).items() for r in text.to_value(part).collect()
    ]
    assert got == sorted(want)


def test_search_rows(spark):
    df = pages(spark, log_row("a", 1, last="search", item="x y"), log_row("a", 2, last="search"), log_row("a", 3, item="z"))
    assert [(r.full_word, r.ts) for r in logs.search_rows(df).collect()] == [("x y", 1)]


# ---- joins


def order(id, ms, **more):
    return Row(**{f.name: {"id": id, "create_time": ms, **more}.get(f.name) for f in S.ORDER_INFO.fields})


def detail(id, order_id, ms, **more):
    known = {"id": id, "order_id": order_id, "create_time": ms, **more}
    return Row(**{f.name: known.get(f.name) for f in S.ORDER_DETAIL.fields})


def with_rt(spark, rows, schema, ms="create_time"):
    return times.with_event_time(spark.createDataFrame(rows, schema), ms)


def test_order_interval_ends_are_inside(spark):
    base = 1_700_000_000_000
    orders = with_rt(spark, [order(1, base, user_id=5)], S.ORDER_INFO)
    offsets = [-5_001, -5_000, 0, 5_000, 5_001]
    details = with_rt(spark, [detail(i, 1, base + o) for i, o in enumerate(offsets)], S.ORDER_DETAIL)
    wide = joins.order_wide_project(joins.order_wide_interval_join(orders, details))
    assert sorted(r.detail_id for r in wide.collect()) == [1, 2, 3]
    assert {r.create_time for r in wide.collect()} == {base}
    assert wide.columns == [f.name for f in S.ORDER_WIDE.fields if f.name not in S.ORDER_WIDE_DIMS]


def test_payment_interval_is_lopsided(spark):
    base = 1_700_000_000_000
    payment = Row(**{f.name: {"id": 9, "order_id": 1, "create_time": base, "total_amount": None}.get(f.name) for f in S.PAYMENT_INFO.fields})
    payments = with_rt(spark, [payment], S.PAYMENT_INFO)
    offsets = [-900_001, -900_000, 0, 5_000, 5_001]
    rows = [
        Row(**{f.name: {"order_id": 1, "detail_id": i, "create_time": base + o}.get(f.name) for f in S.ORDER_WIDE.fields})
        for i, o in enumerate(offsets)
    ]
    out = joins.payment_wide_project(
        joins.payment_wide_interval_join(payments, with_rt(spark, rows, S.ORDER_WIDE))
    )
    assert out.schema.simpleString() == S.PAYMENT_WIDE.simpleString()
    assert sorted(r.detail_id for r in out.collect()) == [1, 2, 3]
    assert {(r.payment_id, r.payment_create_time) for r in out.collect()} == {(9, base)}


@pytest.mark.parametrize("slot", [40, 100, 7_000])
def test_interval_join_brute_force(spark, slot):
    rng = random.Random(slot)
    left = [(rng.choice("aab"), rng.randrange(2_000)) for _ in range(60)]
    right = [(rng.choice("aab"), rng.randrange(2_000)) for _ in range(60)]
    frames = [with_rt(spark, rows, "k string, ms long", "ms") for rows in (left, right)]
    joined = joins.interval_join(*frames, [("k", "k")], -30, 70, slot)
    got = sorted(joined.select("l.k", F.col("l.ms").alias("a"), F.col("r.ms").alias("b")).collect())
    want = sorted((k, a, b) for k, a in left for j, b in right if k == j and a - 30 <= b <= a + 70)
    assert [tuple(r) for r in got] == want


def test_dim_lookup_keeps_rows_without_match(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "sku bigint, v string")
    dim = spark.createDataFrame([("1", "one")], "id string, name string")
    out = joins.dim_lookup_join(df, dim, "sku", {"name": "sku_name"})
    assert sorted((r.v, r.sku_name) for r in out.collect()) == [("x", "one"), ("y", None), ("z", None)]


def test_large_dimension_is_not_broadcast(spark, small):
    from tidemart.plans.layers import Layers

    layers = Layers(spark, small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = layers.order_wide_full().select("detail_id", *S.ORDER_WIDE_DIMS)
        assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().toString()
        far = sorted(map(str, shuffled.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert far == sorted(map(str, layers.order_wide_full().select("detail_id", *S.ORDER_WIDE_DIMS).collect()))


def test_sql_interval_join(spark):
    rows = [(1, 10, "a", 100), (1, 11, "a", 30_000)]
    a = spark.createDataFrame(rows, "user_id long, item_id long, behavior string, ms long")
    a = a.withColumn("ts", F.timestamp_millis("ms")).drop("ms")
    b = spark.createDataFrame([(1, 20, "b", 20_100)], "user_id long, item_id long, behavior string, ms long")
    b = b.withColumn("ts", F.timestamp_millis("ms")).drop("ms")
    out = joins.sql_interval_join(a, b)
    assert sorted((r.item_id, r.item_id0) for r in out.collect()) == [(10, 20), (11, 20)]


# ---- changes and rules


def change(op, after=None, before=None, table="t", ts="5"):
    return json.dumps({"source": {"db": "d", "table": table}, "before": before, "after": after, "op": op, "ts_ms": ts})


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_cdc_operations(spark):
    out = C.cdc_normalize(texts(spark, *[change(op, {"id": 1}) for op in "rcudx"])).collect()
    assert [r.type for r in out] == ["insert", "insert", "update", "delete", "x"]
    assert out[0].after == {"id": "1"} and out[0].database == "d" and out[0].ts_ms == "5"


def test_drop_deletes_keeps_null_type(spark):
    df = spark.createDataFrame([("delete",), ("insert",), (None,)], "type string")
    assert sorted(str(r.type) for r in routing.drop_deletes(df).collect()) == ["None", "insert"]


def rules(spark, *rows):
    return spark.createDataFrame(
        rows, "source_table string, operate_type string, sink_type string, sink_table string, sink_columns string, "
        "sink_pk string, sink_extend string, arrival long",
    )


def test_first_rule_wins(spark):
    df = rules(
        spark, ("t", "insert", "kafka", "late", "id", None, None, 9), ("t", "insert", "kafka", "early", "id", None, None, 2),
    )
    assert [r.sink_table for r in routing.rules_first_wins(df).collect()] == ["early"]
    assert [r.sink_table for r in routing.rules_first_wins(df, latest=True).collect()] == ["late"]


def test_route_prunes_and_drops(spark):
    changes = C.cdc_normalize(
        texts(
            spark, change("c", {"id": 1, "a": 2, " b": 3}), change("u", {"id": 2}), change("d", None, {"id": 1}),
            change("c", {"id": 3}, table="u"),
        )
    )
    df = rules(
        spark, ("t", "insert", "kafka", "x", "id, b", None, None, 1), ("t", "update", "other", "y", "id", None, None, 1),
        ("t", "delete", "kafka", "z", "id", None, None, 1),
    )
    routed = routing.route_by_rules(changes, df)
    assert [(r.sink_table, r.after) for r in routed.collect()] == [("x", {"id": "1", " b": "3"})]
    assert [tuple(r) for r in topics.topic_rows(routing.to_topics(routed)).collect()] == [("x", '{"id":"1"," b":"3"}')]


def test_rule_records(spark):
    rule = {f.name: f.name[:3] for f in S.RULE.fields}
    out = C.cdc_snapshot_rules(texts(spark, change("r", rule, ts="7"), change("d", None, rule))).collect()
    assert len(out) == 1 and out[0].sink_table == "sin" and out[0].arrival == 7


def test_upsert_keeps_unnamed_columns(spark, tmp_path):
    root = str(tmp_path)

    def apply(*records):
        changes = C.cdc_normalize(texts(spark, *records))
        dimensions.upsert_dim(changes, root, "T", "id,a,b", None)
        return {r.id: (r.a, r.b) for r in dimensions.read_dim(spark, root, "T").collect()}

    one = [change("c", {"id": 1, "a": "x", "b": "y"}, ts="1"), change("u", {"id": 1, "a": "z"}, ts="2")]
    assert apply(*one, change("c", {"id": 2, "a": "p"}, ts="1")) == {"1": ("z", "y"), "2": ("p", None)}
    last = change("u", {"id": 1, "b": None}, ts="3")
    assert apply(last) == {"1": ("z", None), "2": ("p", None)}
    assert apply(last) == {"1": ("z", None), "2": ("p", None)}  # a repeat changes nothing
    assert apply(*one) == {"1": ("z", None), "2": ("p", None)}  # nor does what came late
    assert apply(change("c", {"id": 3, "a": "new"}, ts="1")) == {"1": ("z", None), "2": ("p", None), "3": ("new", None)}
    for value in range(2, 7):  # at the same time, the last to arrive counts
        state = apply(change("u", {"id": 2, "b": str(value)}, ts="9"))
    assert state["2"] == ("p", "6")
    dimensions.compact_dim(spark, root, "T")
    assert apply(change("u", {"id": 2, "b": "old"}, ts="8")) == state
    assert apply(change("u", {"id": 2, "a": "q"}, ts="8"))["2"] == ("q", "6")


def test_ensure_dim_table(spark, tmp_path):
    for _ in range(2):
        dimensions.ensure_dim_table(spark, str(tmp_path), "T", "id,name")
    assert len(list(tmp_path.glob("T/*/*"))) == 1
    table = dimensions.read_dim(spark, str(tmp_path), "T")
    assert table.dtypes == [("id", "string"), ("name", "string")] and table.count() == 0
    with pytest.raises(ValueError):
        dimensions.read_dim(spark, str(tmp_path), "none")
    with pytest.raises(ValueError):
        dimensions.upsert_dim(change_rows(spark, {"id": "1"}), str(tmp_path), "T", "id,change_ms")


def change_rows(spark, *after):
    return spark.createDataFrame([("u", a, str(i)) for i, a in enumerate(after)], "type string, after map<string,string>, ts_ms string")


def test_dim_table_takes_new_columns(spark, tmp_path):
    root = str(tmp_path)
    dimensions.upsert_dim(change_rows(spark, {"id": "1", "a": "x"}), root, "T", "id,a")
    dimensions.upsert_dim(change_rows(spark, {"id": "1", "b": "y"}, {"id": "2", "b": "z", "a": "w"}), root, "T", "id,b")
    dimensions.upsert_dim(change_rows(spark, {"id": "3"}), root, "T", "id")
    dimensions.ensure_dim_table(spark, root, "T", "id,c")
    want = [("1", "x", "y", None), ("2", None, "z", None), ("3", None, None, None)]
    for _ in range(2):
        table = dimensions.read_dim(spark, root, "T")
        assert sorted(table.columns) == ["a", "b", "c", "id"]
        assert sorted(map(tuple, table.select("id", "a", "b", "c").collect())) == want
        dimensions.compact_dim(spark, root, "T")


def test_dim_merge_in_any_order(spark, tmp_path):
    """Batches in any order, repeated, compacted at any time: the state by hand."""
    rng = random.Random(4)
    records = []
    for t in range(120):
        named = rng.sample(["a", "b", "c"], rng.randrange(4))
        records.append(("u", {"id": rng.choice(["hot", "hot", "x", "y"]), **{c: rng.choice([None, str(t)]) for c in named}}, str(t)))
    state = {}
    for _, after, _ in records:
        state.setdefault(after["id"], {"a": None, "b": None, "c": None}).update({k: v for k, v in after.items() if k != "id"})
    batches = [records[i : i + 20] for i in range(0, 120, 20)]
    for seed in range(2):
        order, root = batches + batches[:2], f"{tmp_path}/{seed}"
        random.Random(seed).shuffle(order)
        for i, batch in enumerate(order):
            df = spark.createDataFrame(batch, "type string, after map<string,string>, ts_ms string")
            dimensions.upsert_dim(df, root, "T", "id,a,b,c")
            if i in (2, 5):
                dimensions.compact_dim(spark, root, "T")
        got = {r.id: {"a": r.a, "b": r.b, "c": r.c} for r in dimensions.read_dim(spark, root, "T", ["id", "a", "b", "c"], "id").collect()}
        assert got == state


def test_a_dim_reader_is_not_disturbed_by_compaction(spark, tmp_path):
    root = str(tmp_path)
    dimensions.upsert_dim(change_rows(spark, *[{"id": str(i), "a": "0"} for i in range(40)]), root, "T", "id,a")
    slow_reader = dimensions.read_dim(spark, root, "T")
    before = {p for p in tmp_path.glob("T/**/*.parquet")}
    for i in range(1, 4):
        dimensions.upsert_dim(change_rows(spark, *[{"id": "7", "a": str(i)}] * 60), root, "T", "id,a")
        dimensions.compact_dim(spark, root, "T")
    assert before <= {p for p in tmp_path.glob("T/**/*.parquet")}
    assert slow_reader.filter("a = '0'").count() == 40
    table = dimensions.read_dim(spark, root, "T", ["id", "a"], "id")
    assert {r.id: r.a for r in table.collect()} == {str(i): "3" if i == 7 else "0" for i in range(40)}
    plan = table.filter("id = '7'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(change_key,7)" in plan  # a condition on the key reaches the files
    # and only what the last compaction wrote is read
    used = [f for f in dimensions._current(dimensions._folder(spark, f"{root}/T", ["a"])).select(F.input_file_name()).distinct().collect()]
    assert len(used) == 1


def test_lookup_in_a_table_not_made_yet(spark, tmp_path):
    dims = {n: dimensions.read_dim(spark, str(tmp_path), n, c) for n, c in joins.ORDER_DIMS.items()}
    lines = spark.createDataFrame([(1, 2, 3)], "user_id long, sku_id long, province_id long")
    out = joins.order_wide_dims(lines, dims).first()
    assert out.user_id == 1 and out.spu_name is None and out.user_gender is None


def test_a_retried_batch_adds_what_was_not_published(spark, tmp_path):
    rows = spark.createDataFrame([("x", "1"), ("y", "2"), ("x", "3")], "topic string, value string")
    topics.write_topic_dynamic(rows.filter("topic = 'x'"), str(tmp_path), 1, "a")  # the attempt got to one topic only
    before = {p.name for p in tmp_path.glob("topic=x/**/*.txt")}
    for batch, writer in ((0, "a"), (1, "a"), (1, "a"), (1, "b")):
        topics.write_topic_dynamic(rows, str(tmp_path), batch, writer)
    assert before <= {p.name for p in tmp_path.glob("topic=x/**/*.txt")}
    for name, values in (("x", ["1", "1", "1", "3", "3", "3"]), ("y", ["2", "2", "2"])):
        assert sorted(r.value for r in spark.read.text(f"{tmp_path}/topic={name}").collect()) == values


def test_no_record_is_lost_when_batch_numbers_come_again(spark, tmp_path):
    """Writers of two checkpoints, calls without a number, and a null topic that came first."""
    uri = str(tmp_path)
    rows = [spark.createDataFrame([("t", x)], "topic string, value string") for x in "abcd"]
    topics.write_topic_dynamic(rows[0], uri, 0, "job-1")
    topics.write_topic_dynamic(rows[1], uri, 0, "job-2")
    for df in rows[2:]:
        topics.write_topic_dynamic(df, uri)
    nothing = spark.createDataFrame([(None, "n"), ("", "n")], "topic string, value string")
    topics.write_topic_dynamic(nothing, uri, 1, "job-1")
    for _ in range(2):
        topics.write_topic_dynamic(nothing.unionAll(spark.createDataFrame([("t", "e"), ("007", "f")], "topic string, value string")), uri, 1, "job-1")
    assert sorted(r.value for r in spark.read.text(f"{uri}/topic=t").collect()) == list("abcde")
    assert [r.value for r in spark.read.text(f"{uri}/topic=007").collect()] == ["f"]
    with pytest.raises(ValueError):
        topics.write_topic_dynamic(rows[0], uri, 3)


def test_files_per_topic_and_batch(spark, tmp_path):
    rows = spark.range(4000).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("value"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        topics.write_topic_dynamic(rows.repartition(16), str(tmp_path), 0, "w", files=2)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 1 <= len(list(tmp_path.glob("topic=t/writer=w/batch_id=0/*.txt"))) <= 2
    assert spark.read.text(f"{tmp_path}/topic=t").count() == 4000


def test_log_records_go_on_whole(spark):
    lines = [
        '{"common":{"mid":"m","uid":"7","is_new":"1"},"page":{"page_id":"home","source_type":"q"},"displays":[{"item":"3","pos_id":2},{"ts":1}],"actions":[{"a":1}],"err":{"code":7},"ts":100}',
        '{"common":{"mid":"m","uid":"7","is_new":"1","deep":{"x":[1,null]}},"page":{"page_id":"p"},"extra":"1","ts":200}',
        "not json", "[1]", None, '{"common":{"mid":"n","is_new":"0"},"start":{"entry":"icon","first":1},"ts":5}',
    ]
    log = logs.parse_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    out = {}
    for r in logs.log_topics(logs.fix_is_new(log)).collect():
        out.setdefault(r.topic, []).append(r.value)
    second = json.loads(lines[1])
    second["common"]["is_new"] = "0"
    assert sorted(out[S.TOPIC_UNREADABLE]) == ["", "[1]", "not json"]
    assert lines[0] in out[S.TOPIC_PAGE] and second in map(json.loads, out[S.TOPIC_PAGE]) and len(out[S.TOPIC_PAGE]) == 2
    assert out[S.TOPIC_START] == [lines[5]]
    origin = {"mid": "m", "page_id": "home", "ts": 100}
    assert [json.loads(x) for x in out[S.TOPIC_DISPLAY]] == [{"item": "3", "pos_id": 2, **origin}, origin]


def test_a_log_split_outlives_any_json(spark):
    shown = ["a", 7, None, [1], True, 1.5, {"item": "1", "deep": [None]}, {}]
    lines = [
        json.dumps({"common": {"mid": "m"}, "page": {"page_id": "p"}, "displays": shown, "ts": 1}),
        '{"common":"x","page":[],"displays":"y","ts":2}', '{"common":[{"is_new":"1"}],"displays":{"item":"2"},"ts":"z"}',
        '{"common":null,"displays":[[],[{}]],"ts":null}', '{"a":1,"a":2}', '"text"', "{}", "7", "null", "",
    ]
    log = logs.parse_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    for rows in (log, logs.fix_is_new(log)):
        out = {}
        for r in logs.log_topics(rows).collect():
            out.setdefault(r.topic, []).append(r.value)
        odd = ['"a"', "7", "null", "[1]", "true", "1.5", "[]", "[{}]"]
        assert sorted(out[S.TOPIC_UNREADABLE]) == sorted([*odd, lines[4], '"text"', "7", "null", ""])
        assert sorted(out[S.TOPIC_PAGE]) == sorted([*lines[:4], "{}"])
        origin = {"mid": "m", "page_id": "p", "ts": 1}
        assert [json.loads(x) for x in out[S.TOPIC_DISPLAY]] == [{"item": "1", "deep": [None], **origin}, origin]
        whole = [r.value for r in logs.log_topics(rows, whole_record=True).filter(F.col("topic") == S.TOPIC_DISPLAY).collect()]
        assert whole == [lines[0]] * 2


def test_unreadable_lines_are_told_apart(spark):
    lines = ['{"id":"1","n":2}', '{"id":1,"n":"x"}', '{"n":2}', "{", "", None, "[]", '[{"id":1}]', "1", '  {"id":5}', '{"id":{"a":1},"n":3}']
    shape = "id BIGINT, n BIGINT"
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    flat = text.checked_json(df, StructType.fromDDL(shape), ("id",), flat=True)
    assert sorted(map(str, text.readable_rows(flat).collect())) == ["Row(id=1, n=2)", "Row(id=1, n=None)", "Row(id=5, n=None)"]
    lost = [json.loads(r.value) for r in text.unreadable_lines(flat, "t").collect()]
    assert sorted(x["line"] for x in lost) == sorted(['{"n":2}', "{", "", "", "[]", '[{"id":1}]', "1", '{"id":{"a":1},"n":3}'])
    assert {x["topic"] for x in lost} == {"t"}
    typed = text.checked_json(df, StructType.fromDDL(shape))
    assert sorted(str(r.n) for r in text.readable_rows(typed).collect()) == ["2", "None"]
    events = spark.createDataFrame([("a,5",), ("b",), ("c,x",), (None,)], "value string")
    read = text.readable_rows(TB.checked_csv_event(events)).collect()
    assert [tuple(r) for r in read] == [("a", 1, 5)]
    assert text.unreadable_lines(TB.checked_csv_event(events), "csv").count() == 3


# ---- facts and statistics


def test_visitor_facts_without_duration(spark):
    df = pages(spark, log_row("a", 1, during=None))
    assert facts.visitor_facts(df, df, df)[0].first().dur_sum == 0


def test_page_product_rows(spark):
    df = pages(
        spark, log_row("a", 1, page="good_detail", item="4", item_type="sku_id", displays=[("5", "sku_id"), ("6", "other")]),
        log_row("a", 2, page="good_list", item="4", item_type="sku_id"),
    )
    rows = facts.page_product_rows(df).collect()
    assert sorted((r.sku_id, r.click_ct, r.display_ct) for r in rows) == [(4, 1, 0), (5, 0, 1)]


def test_distinct_orders_per_window(spark):
    rows = [(1, 7, "1.10", 1_000), (1, 7, "2.20", 2_000), (1, 8, "3.30", 3_000), (1, 8, "4.40", 11_000), (2, 9, "1.00", 0)]
    wide = spark.createDataFrame(rows, "province_id long, order_id long, split_total_amount string, create_time long")
    wide = wide.withColumn("split_total_amount", F.col("split_total_amount").cast("decimal(16,2)"))
    out = stats.province_stats(times.with_event_time(wide, "create_time"))
    got = {(r.province_id, r.stt[-8:]): (str(r.order_amount), r.order_count, r.ts) for r in out.collect()}
    assert got == {(1, "00:00:00"): ("6.60", 2, 1_000), (1, "00:00:10"): ("4.40", 1, 11_000), (2, "00:00:00"): ("1.00", 1, 0)}


def test_reports(spark):
    sold = spark.createDataFrame([("2024-01-05 23:59:50", "5.00"), ("2024-01-06 00:00:00", "1.00")], "stt string, order_amount string")
    sold = sold.withColumn("order_amount", F.col("order_amount").cast("decimal(16,2)"))
    assert str(reports.daily_gmv(sold, 20240105).first()[0]) == "5.00"
    assert reports.daily_gmv(sold, 20240107).first()[0] is None
    words = spark.createDataFrame([("2024-01-05 00:00:00", w, c) for w, c in [("b", 2), ("a", 2), ("c", 9), ("b", 1)]], "stt string, keyword string, ct long")
    assert [tuple(r) for r in reports.keyword_topn(words, 20240105, 2).collect()] == [("c", 9), ("b", 3)]


# ---- functions


def test_times(spark):
    ms = 1_689_059_879_421
    row = spark.range(1).select(
        times.ymd(F.lit(ms)), times.ymd_hms(F.lit(ms + 12 * 3_600_000)), times.utc_text(F.lit(ms)),
        times.utc_text(F.lit(1_689_059_880_000)), times.utc_text(F.lit(1_689_059_880_400)), times.yyyymmdd(F.lit("2023-07-11 01:02:03")),
    ).first()
    assert list(row) == [
        "2023-07-11", "2023-07-11 19:17:59", "2023-07-11 07:17:59.421", "2023-07-11 07:18:00", "2023-07-11 07:18:00.4", 20230711,
    ]


def test_utc_text_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert spark.range(1).select(times.utc_text(F.lit(0))).first()[0] == "1970-01-01 00:00:00"
        assert spark.range(1).select(times.ymd_hms(F.lit(0))).first()[0] == "1970-01-01 09:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_prune_keeps_long_numbers_exact(spark):
    record = {"id": 9007199254740993123, "price": 12.50, "name": "a,b", "tags": [1, 2]}
    df = C.cdc_normalize(texts(spark, change("c", record)))
    out = routing.prune_columns(df, F.split(F.lit("id,tags,other"), ",")).first()
    assert out.after == {"id": "9007199254740993123", "tags": "[1,2]"}


def test_parse_record_takes_quoted_and_bare_numbers(spark):
    df = texts(spark, '{"sku_id":"5","create_time":7}', '{"sku_id":"x"}', "broken")
    out = [tuple(r) for r in text.parse_record(df, S.SKU_ACTION).collect()]
    assert out == [(5, 7), (None, None), (None, None)]


def test_csv_event(spark):
    out = TB.parse_csv_event(texts(spark, "k,12", "bad")).collect()
    assert [tuple(r) for r in out] == [("k", 1, 12), ("bad", 1, None)]


def test_scan_jdbc_table_text(spark):
    df = spark.createDataFrame([(1, "a", None)], "id int, name string, x string")
    assert TB.scan_jdbc_table(df).first().value == "1,a,null"


def test_tuple_text(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert df.select(text.tuple_text("x", "y")).first()[0] == "(a,1)"


def test_words(spark):
    df = spark.createDataFrame([(1, "Hello_WORLD x1"), (2, "。，"), (3, None)], "id int, full_word string")
    out = sorted((r.id, str(r.word)) for r in tokens.split_words(df).collect())
    assert out == [(1, "hello"), (1, "world"), (1, "x1"), (2, "None"), (3, "None")]


def test_words_of_all_scripts(spark):
    words = {
        "Café ÉLAN naïve": ["café", "naïve", "élan"], "Москва-2024": ["2024", "москва"], "東京タワー spark": ["spark", "タワー", "東京"],
        "한국어 x": ["x", "한국어"], "大数据spark三": ["spark", "三", "大数据"],
    }
    df = spark.createDataFrame([(t,) for t in words], "full_word string").withColumn("id", F.col("full_word"))
    got = {}
    for r in tokens.split_words(df).collect():
        got.setdefault(r.id, []).append(r.word)
    assert {t: sorted(w) for t, w in got.items()} == words


@pytest.mark.parametrize("singles", [True, False])
def test_chinese_words_brute_force(spark, singles):
    sentence = "我们在上海数据中心用spark处理订单数据，每天统计热门关键词和商品销量，中华人民共和国成立"
    known = ["我们", "上海", "上海数据", "数据", "数据中心", "中心", "处理", "订单", "订单数据", "每天", "统计", "热门", "关键词", "关键", "商品", "销量", "中华人民共和国", "共和国"]
    df = spark.createDataFrame([(sentence,)], "full_word string")
    dictionary = spark.createDataFrame([(w,) for w in known], "word string")
    got = sorted(r.word for r in tokens.split_words(df, dictionary=dictionary, singles=singles).collect())
    runs = "我们在上海数据中心用", "处理订单数据", "每天统计热门关键词和商品销量", "中华人民共和国成立"
    parts = [r[i:i + n] for r in runs for n in range(1, len(r) + 1) for i in range(len(r) - n + 1)]
    assert got == sorted(["spark"] + [p for p in parts if p in known or singles and len(p) == 1])


@pytest.mark.parametrize("way", ["table", "search", "cut"])
def test_han_words_are_found_by_a_trie(spark, monkeypatch, way):
    """a place gives the dictionary words that begin there, not all substrings of their lengths, and a text's repeats are counted."""
    from collections import Counter

    monkeypatch.setattr(tokens, *{"table": ("TABLE_ENTRIES", 1 << 22), "search": ("TABLE_ENTRIES", 0), "cut": ("TRIE_CHARS", 0)}[way])
    rnd = random.Random(4)
    known = {"".join(rnd.choices("上海数据𠀀", k=rnd.randint(2, 4))) for _ in range(30)}
    texts = ["".join(rnd.choices("上海数据𠀀中 xX", k=rnd.randint(0, 60))) for _ in range(40)] + [None, "", "。", "上"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    prefixes = tokens.Prefixes(spark.createDataFrame([(w,) for w in [*known, *known, "xx", None]], "word string"))
    assert (prefixes.trie is None) == (way == "cut")
    if prefixes.trie is not None:  # as workers do it, a few characters at a time
        monkeypatch.setattr(tokens, "WALK_CHARS", 7)
        step, whole = prefixes.trie.walker(), [t.replace("x", " ").replace("X", " ") + " " for t in texts if t]
        row, word, n = prefixes.trie.found("".join(whole), [len(t) for t in whole], step)
        once = [prefixes.trie.found(t, [len(t)], step) for t in whole]
        assert Counter(zip(row.tolist(), word.tolist(), n.tolist())) == Counter((i, *x) for i, (_, w, k) in enumerate(once) for x in zip(w.tolist(), k.tolist()))
    want = Counter()
    for i, t in enumerate(texts):
        runs = re.findall("[上海数据𠀀中]+|[xX]+", t or "")
        words = [w for r in runs for w in ([r.lower()] if r[0] in "xX" else [r[a:b] for a in range(len(r)) for b in range(a + 1, len(r) + 1)])]
        kept = [w for w in words if len(w) == 1 or w in known or w[0] == "x"]
        want.update((i, w) for w in kept or [None])
    rows = tokens.candidate_words(df, "text", prefixes)
    if way != "cut":
        assert Counter((r.id, r.word) for r in rows.collect()) == want
        assert {r.word for r in rows.filter("_han").collect()} == {w for _, w in want if w and w[0] != "x"}
    counted = tokens.candidate_words(df, "text", prefixes, counts="n").groupBy("id", "_han", "word").agg(F.sum("n").alias("n"))
    found = tokens.in_dictionary(counted, spark.createDataFrame([(w,) for w in known], "word string"))
    assert {(r.id, r.word): r.n for r in found.collect()} == dict(want)


def test_counting_reads_the_texts_once(spark, small):
    """the words are not made a second time for those that bypass the dictionary."""
    from tidemart.plans.registry import QUERIES

    plan = QUERIES["keyword_tokens_han"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"doc_id#\d+L?,text#\d+[^\n]*parquet", plan)) == 1


def test_keyword_stats_counts_then_checks(spark):
    rows = [("大数据 spark", 1_000), ("大数据", 2_000), ("Spark", 11_000)]
    df = times.with_event_time(spark.createDataFrame(rows, "full_word string, ts long"))
    dictionary = spark.createDataFrame([("大数据",)], "word string")
    out = stats.keyword_stats(df, dictionary=dictionary, singles=False).collect()
    assert sorted((r.keyword, r.stt[-8:], r.ct, r.ts) for r in out) == [
        ("spark", "00:00:00", 1, 1_000), ("spark", "00:00:10", 1, 11_000), ("大数据", "00:00:00", 2, 1_000),
    ]
    without = stats.keyword_stats(df).collect()
    assert sorted((r.keyword, r.ct) for r in without) == [("spark", 1), ("spark", 1), ("大数据", 2)]


def test_shuffle_sizing(spark):
    from tidemart.session import size_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 10 << 40) == 81_920
        assert size_shuffles(spark, 1) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_now_is_whole_seconds(spark):
    import time

    now = spark.range(1).select(times.now_ms()).first()[0]
    assert now % 1000 == 0 and abs(now / 1000 - time.time()) < 60


def test_reports_read_one_day(spark, tmp_path):
    rows = [(f"2024-01-0{d} 10:00:00", f"w{d}", d) for d in (4, 5, 6)]
    df = spark.createDataFrame(rows, "stt string, keyword string, ct long")
    write_stats(df, str(tmp_path))
    one_day = read_stats(spark, str(tmp_path), df.schema, "2024-01-05")
    assert len(one_day.inputFiles()) == 1 and "2024-01-05" in one_day.inputFiles()[0]
    for stored in (one_day, read_stats(spark, str(tmp_path)), read_stats(spark, str(tmp_path), day="2024-01-05")):
        assert [tuple(r) for r in reports.keyword_topn(stored, 20240105).collect()] == [("w5", 5)]
    assert read_stats(spark, str(tmp_path), df.schema, "2023-01-01").count() == 0
    report = reports.keyword_topn(read_stats(spark, str(tmp_path)), 20240105)
    plan = report._jdf.queryExecution().toString()
    filters = plan[plan.rindex("PartitionFilters: [") :].split("]")[0]
    assert "day" in filters and "2024-01-05" in filters
    with pytest.raises(ValueError):
        read_stats(spark, f"{tmp_path}/none")


def test_batches_of_statistics_are_compacted(spark, tmp_path):
    """Fifty batches with a retry, two writers and two calls with the defaults: no row lost or doubled, one file left to read."""
    path, shape = str(tmp_path), "stt string, k long"
    day, rows = "2024-01-05", []

    def batch(i):
        return spark.createDataFrame([(f"{day} 10:00:{i:02d}", i), (f"2024-01-06 00:00:{i:02d}", i)], shape)

    for i in range(48):
        write_stats(batch(i), path, i, "job-1")
        rows.append(i)
    write_stats(batch(47), path, 47, "job-1")
    write_stats(batch(100), path, 0, "job-2")  # another checkpoint, the same number
    for i in (101, 102):
        write_stats(batch(i), path)
    rows += [100, 101, 102]
    early = read_stats(spark, path, batch(0).schema, day)
    for later in (None, 103):
        if later:
            write_stats(batch(later), path, 48, "job-1")
            rows.append(later)
        for _ in range(2):
            compact_stats(spark, path, day)
            for stored in (read_stats(spark, path, batch(0).schema, day), read_stats(spark, path).filter(F.col("day") == day)):
                assert sorted(r.k for r in stored.collect()) == rows
            assert sorted(r.k for r in read_stats(spark, path, day="2024-01-06").collect()) == rows
    used = read_stats(spark, path, batch(0).schema, day).select(F.input_file_name().alias("f")).distinct()
    assert used.count() == 1
    assert sorted(r.k for r in early.collect()) == rows[:-1]  # a reader from before
    with pytest.raises(ValueError):
        write_stats(batch(0), path, 3)


def test_a_small_day_gets_one_file(spark, tmp_path):
    rows = spark.range(3000).select(F.concat(F.date_format(F.timestamp_seconds(F.col("id") * 3600), "yyyy-MM-dd HH:mm:ss")).alias("stt"), "id")
    rows = rows.unionAll(spark.range(1000).select(F.lit("1970-03-01 00:00:00").alias("stt"), "id"))
    for adaptive in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            write_stats(rows.repartition(16), f"{tmp_path}/{adaptive}", rows_per_file=300)
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        files = {day.name: len(list(day.glob("**/*.parquet"))) for day in tmp_path.glob(f"{adaptive}/batches/day=*")}
        assert 2 <= files.pop("day=1970-03-01") <= 4 and set(files.values()) == {1} and len(files) > 100


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_visits_are_hash_aggregated(spark, small):
    plan = plan_of(logs.unique_visit(D.page_log(spark, small)))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_facts_are_looked_up_once_for_products(spark, small):
    lines = D.order_detail(spark, small).select("id", "sku_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.product_dims(lines, D.dimensions(spark, small))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    top = plan[: plan.index("l_orderkey")]  # the joins above the scan of the lines, down its side of the tree
    assert top.count("Join LeftOuter") == 1


def test_statistics_are_shuffled_without_day_and_batch(spark, tmp_path, monkeypatch):
    """the day and the batch name are added after the shuffle, not carried through the cache and the exchange."""
    from tidemart.sinks import stats as sink

    dealt, by_size = [], sink._by_size

    def seen(rows, *args, **kwargs):
        dealt.append(rows.columns)
        return by_size(rows, *args, **kwargs)

    monkeypatch.setattr(sink, "_by_size", seen)
    df = spark.createDataFrame([("2024-01-05 10:00:00", "w", 2), ("2024-01-06 10:00:00", "v", 3)], "stt string, keyword string, ct long")
    write_stats(df, str(tmp_path))
    assert dealt == [["stt", "keyword", "ct"]]
    stored = read_stats(spark, str(tmp_path), df.schema)
    assert sorted(tuple(r) for r in stored.collect()) == [("2024-01-05 10:00:00", "w", 2, "2024-01-05"), ("2024-01-06 10:00:00", "v", 3, "2024-01-06")]


def test_words_of_a_window_are_counted_where_its_texts_are(spark, tmp_path, monkeypatch):
    """only texts are shuffled, once; what lies together by day is written from there, a small day to one file."""
    from tidemart.sinks import stats as sink

    rows = [(f"w{i % 7} w{i % 3} Same same", i * 4_000) for i in range(3000)] + [("w1", None), (None, 5), ("a b", 10**12), ("b", 10**12 + 86_400_000)]
    searches = times.with_event_time(spark.createDataFrame(rows, "full_word string, ts long"))
    want = sorted(map(str, stats.keyword_stats(searches).collect()))
    dealt, place = stats.windows_together(searches, task_bytes=16_000)
    counted = stats.keyword_stats(dealt, place=place)
    plan = plan_of(counted)
    assert len(re.findall(r"Exchange hashpartitioning", plan[: plan.find("Initial Plan")] if "Initial Plan" in plan else plan)) == 1
    monkeypatch.setattr(sink, "_by_size", lambda *_: pytest.fail("dealt out again"))
    monkeypatch.setattr(type(counted), "persist", lambda *_: pytest.fail("cached"))
    write_stats(counted, str(tmp_path), rows_per_file=9_000, together=True)
    stored = read_stats(spark, str(tmp_path), counted.schema)
    assert sorted(map(str, stored.drop("day").collect())) == want
    files = {day.name: len(list(day.glob("**/*.parquet"))) for day in tmp_path.glob("batches/day=*")}
    assert files == {"day=1970-01-01": files["day=1970-01-01"], "day=2001-09-09": 1, "day=2001-09-10": 1} and 1 < files["day=1970-01-01"] <= 4
    assert stats.windows_together(searches, task_bytes=3)[1] is None  # a window of more text than a task should have


def test_stored_keywords_lie_together(spark, small, monkeypatch):
    """the report's statistics are written without a second shuffle."""
    from tidemart.plans import registry

    asked = []
    monkeypatch.setattr(registry, "STORED", {})
    monkeypatch.setattr(registry, "write_stats", lambda df, path, **how: asked.append(how) or write_stats(df, path, **how))
    assert registry.QUERIES["keyword_topn"](spark, small).count() == 5 and asked == [{"together": True}]
