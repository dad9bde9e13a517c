"""Operators on small literal inputs with answers derived by hand."""

import pytest
from pyspark.sql import functions as F

from rillmark.functions.aggregate import rows, weighted_avg
from rillmark.functions.registry import register_functions
from rillmark.functions.text import split_text
from rillmark.functions.text import event_text, parse_long, string_hash, tokens
from rillmark.functions.time import event_time, timestamp_text, window_start_ms
from rillmark.operators import aggregates, distribute, joins, patterns, project, ranking, state, windows
from rillmark.operators.late import timer_firings
from rillmark.session import shared_folder
from rillmark.sources.readers import CLICK, accepted, as_table, csv_table, literal_rows, parse_records, rejected, schema_text


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def timed(spark, data, columns="key string, ms bigint"):
    return spark.createDataFrame(data, columns).withColumn("ts", event_time("ms"))


CLICKS7 = [
    ("catalina", "home", 1000),
    ("Josh", "cart", 2000),
    ("Silvia", "home", 4500),
    ("Mark", "payment", 4000),
    ("Josh", "order", 3000),
    ("Josh", "detail", 2500),
    ("Josh", "home", 3600),
]


@pytest.fixture(scope="module")
def clicks7(spark):
    rows_ = [(i, *r) for i, r in enumerate(CLICKS7)]
    return spark.createDataFrame(rows_, "seq bigint, username string, url string, timestamp bigint")


def test_word_count_drops_only_trailing_empty_tokens(spark):
    lines = spark.createDataFrame([("a b  c  ",), ("",), ("   ",), ("a",), (None,)], "value string")
    counted = aggregates.count_by(project.tokenize(lines, "value"), "word", "n")
    assert got(counted, "word", "n") == [("", 2), ("a", 2), ("b", 1), ("c", 1)]
    other = lines.select(F.explode(tokens(F.lit("x||y|||"), "|")).alias("t")).limit(3)
    assert [r["t"] for r in other.collect()] == ["x", "", "y"]


def test_filter_map_and_conditional_output(clicks7):
    late = project.project(clicks7, "username", F.col("timestamp") >= 4000)
    assert got(late, "username") == [("Mark",), ("Silvia",)]
    long = project.project(clicks7, "username", F.length("username") >= 5)
    assert got(long, "username") == [("Silvia",), ("catalina",)]


def test_branches_emit_one_or_two_values(clicks7):
    josh, mark = F.col("username") == "Josh", F.col("username") == "Mark"
    out = project.emit(
        clicks7, [(josh | mark, F.col("username")), (mark, F.col("url"))], keep="seq"
    )
    assert got(out, "seq", "out") == [
        (1, "Josh"), (3, "Mark"), (3, "payment"), (4, "Josh"), (5, "Josh"), (6, "Josh")
    ]


def test_rolling_max_by_takes_the_first_on_a_tie(clicks7):
    led = aggregates.rolling_max_by(clicks7, key="username", order="seq", value="timestamp")
    assert got(led, "seq", "best.username", "best.url", "best.timestamp") == [
        (0, "catalina", "home", 1000),
        (1, "Josh", "cart", 2000),
        (2, "Silvia", "home", 4500),
        (3, "Mark", "payment", 4000),
        (4, "Josh", "order", 3000),
        (5, "Josh", "order", 3000),
        (6, "Josh", "home", 3600),
    ]
    tied = clicks7.withColumn("timestamp", F.lit(1).cast("bigint"))
    led = aggregates.rolling_max_by(tied, key="username", order="seq", value="timestamp")
    assert {r[1] for r in got(led, "username", "best.seq") if r[0] == "Josh"} == {1}


def test_rolling_max_keeps_the_other_fields_of_the_first(clicks7):
    led = aggregates.rolling_max(clicks7, key="username", order="seq", value="timestamp", keep="url")
    josh = [r for r in got(led, "seq", "username", "max_timestamp", "first_url") if r[1] == "Josh"]
    assert josh == [(1, "Josh", 2000, "cart"), (4, "Josh", 3000, "cart"), (5, "Josh", 3000, "cart"), (6, "Josh", 3600, "cart")]


def test_leader_changes_to_the_newer_on_a_tie(clicks7):
    led = aggregates.running_leader(clicks7, key="username", order="seq")
    assert got(led, "seq", "leader", "leader_cnt") == [
        (0, "catalina", 1), (1, "Josh", 1), (2, "Silvia", 1), (3, "Mark", 1), (4, "Josh", 2), (5, "Josh", 3), (6, "Josh", 4)
    ]


def test_rule_partitioning(spark):
    numbers = spark.createDataFrame([(i,) for i in range(1, 9)], "value int")
    placed = distribute.by_rule(numbers, 4, F.col("value") % 2)
    assert got(placed, F.spark_partition_id(), "value") == [
        (0, 2), (0, 4), (0, 6), (0, 8), (1, 1), (1, 3), (1, 5), (1, 7)
    ]
    assert placed.rdd.getNumPartitions() == 4


def test_one_task_meets_partial_aggregates_only(spark):
    one = distribute.to_one_task(spark.range(0, 1000, 1, 7), F.count("*").alias("n"), F.sum("id").alias("s"))
    assert got(one, "n", "s") == [(1000, 499_500)]
    assert one.rdd.getNumPartitions() == 1


def test_windows_off_the_slide(spark):
    events = spark.range(0, 60, 3).select(F.lit("a").alias("k"), F.timestamp_seconds("id").alias("ts"))
    shown = ["k", F.unix_seconds("window_start"), "cnt"]
    by_panes = windows.hop(events, ts="ts", size="10 seconds", slide="4 seconds", key="k")
    built_in = windows.hop(events, ts="ts", size="10 seconds", slide="4 seconds", key="k", panes=False)
    assert got(by_panes, *shown) == got(built_in, *shown)
    with pytest.raises(ValueError):
        windows.cumulate(events, ts="ts", size="10 seconds", step="4 seconds", key="k")


LEFT = [(k, t) for k in "ab" for t in (1000, 3000, 5000, 7000, 9000)]
RIGHT = [(k, t) for k in "ab" for t in (2000, 4000, 6000, 8000)]


def test_window_join(spark):
    pairs = joins.window_join(timed(spark, LEFT), timed(spark, RIGHT), key="key", ts="ts", size="5 seconds")
    counted = pairs.groupBy("key", F.unix_millis("window_start").alias("s")).count()
    assert got(counted, "key", "s", "count") == [("a", 0, 4), ("a", 5000, 6), ("b", 0, 4), ("b", 5000, 6)]


def test_window_cogroup_with_an_empty_side(spark):
    left, right = timed(spark, [*LEFT, ("c", 1000)]), timed(spark, RIGHT)
    groups = joins.window_cogroup(left, right, key="key", ts="ts", size="5 seconds", value="ms")
    assert got(groups, "key", "left_list", "right_list", "piece") == [
        ("a", [1000, 3000], [2000, 4000], 0),
        ("a", [5000, 7000, 9000], [6000, 8000], 0),
        ("b", [1000, 3000], [2000, 4000], 0),
        ("b", [5000, 7000, 9000], [6000, 8000], 0),
        ("c", [1000], [], 0),
    ]


def test_cogroup_in_pieces(spark):
    left, right = timed(spark, [("a", t) for t in range(0, 5000, 10)]), timed(spark, [("a", 2500)])
    groups = joins.window_cogroup(left, right, key="key", ts="ts", size="5 seconds", value="ms", piece="1 second")
    pieces = sorted(groups.collect(), key=lambda r: r["piece"])
    assert [(r["piece"], len(r["left_list"]), r["right_list"]) for r in pieces] == [(k, 100, [2500] if k == 2 else []) for k in range(5)]
    assert [v for r in pieces for v in r["left_list"]] == list(range(0, 5000, 10))


def test_interval_join_includes_both_ends(spark):
    left = timed(spark, [("a", 10_000), ("b", 5000), ("n", 0)])
    right = timed(spark, [("a", 7999), ("a", 8000), ("a", 13_000), ("a", 13_001), ("b", 100_000), ("a", 10_000)])
    pairs = joins.interval_join(left, right, key="key", ts="ts", lower_ms=-2000, upper_ms=3000)
    assert got(pairs, "key", "left_ms", "right_ms") == [("a", 10_000, t) for t in (8000, 10_000, 13_000)]


def test_interval_join_against_all_pairs(spark):
    left = timed(spark, [("k%d" % (i % 3), i * i * 7 % 90_000) for i in range(120)])
    right = timed(spark, [("k%d" % (i % 3), i * i * 11 % 90_000) for i in range(120)])
    lefts, rights = left.collect(), right.collect()
    for low, high in ((-2000, 3000), (0, 0), (1000, 1500)):
        pairs = joins.interval_join(left, right, key="key", ts="ts", lower_ms=low, upper_ms=high)
        want = sorted(
            (a["key"], a["ms"], b["ms"])
            for a in lefts
            for b in rights
            if a["key"] == b["key"] and a["ms"] + low <= b["ms"] <= a["ms"] + high
        )
        assert got(pairs, "key", "left_ms", "right_ms") == want


APP = [("order1", 1000), ("order3", 4000), ("order4", 3000), ("order2", 2000)]
THIRD = [("order1", 3000), ("order3", 5000), ("order9", 9000)]
BILLS = [
    ("order1", "match"), ("order2", "third_missing"), ("order3", "match"), ("order4", "third_missing"), ("order9", "app_missing")
]


def test_bill_check(spark):
    checked = joins.reconcile(timed(spark, APP), timed(spark, THIRD), key="key", ts="ts", wait="5 seconds")
    assert got(checked, "key", "status") == BILLS


def test_bill_check_with_often_repeated_ids(spark):
    app = timed(spark, [*APP, *[("hot", t) for t in range(0, 60_000, 700)], (None, 5)])
    third = timed(spark, [*THIRD, *[("hot", t) for t in range(20_000, 99_000, 1300)], (None, 7)])
    found = joins.reconcile(app, third, key="key", ts="ts", wait="2 seconds")
    want = []
    both = lambda side: [(r.key, r.ms) for r in side.select("key", F.unix_millis("ts").alias("ms")).collect()]
    apps, thirds = both(app), both(third)
    fits = lambda x, y: x[0] == y[0] and x[0] is not None and x[1] <= y[1] <= x[1] + 2000
    want += [("match", x[0], x[1], y[1]) for x in apps for y in thirds if fits(x, y)]
    want += [("third_missing", x[0], x[1], None) for x in apps if not any(fits(x, y) for y in thirds)]
    want += [("app_missing", y[0], None, y[1]) for y in thirds if not any(fits(x, y) for x in apps)]
    rows = found.select("status", "key", F.unix_millis("app_ts"), F.unix_millis("third_ts")).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))


def test_bill_without_time_and_short_wait(spark):
    app = spark.createDataFrame([("a", None), ("b", 1000)], "key string, us bigint").select("key", F.timestamp_micros("us").alias("ts"))
    third = spark.createDataFrame([("c", None), ("b", 2500)], "key string, us bigint").select("key", F.timestamp_micros("us").alias("ts"))
    found = joins.reconcile(app, third, key="key", ts="ts", wait="1500 microseconds")
    assert got(found, "key", "status") == [("a", "third_missing"), ("b", "match"), ("c", "app_missing")]
    found = joins.reconcile(app, third, key="key", ts="ts", wait="1499 microseconds")
    assert got(found, "key", "status") == [("a", "third_missing"), ("b", "app_missing"), ("b", "third_missing"), ("c", "app_missing")]


ACTIONS = [(0, "Catalina", "login"), (1, "Catalina", "pay"), (2, "Bob", "login"), (3, "Bob", "order")]


def test_rules(spark):
    actions = spark.createDataFrame(ACTIONS, "seq bigint, user string, action string")
    rules = spark.createDataFrame([(0, "login", "pay"), (1, "login", "order")], "seq int, action1 string, action2 string")
    every = joins.match_rules(actions, rules, key="user", order="seq", action="action")
    assert got(every, "user", "action") == [("Bob", "order"), ("Catalina", "pay")]
    last = joins.match_rules(actions, joins.latest_rule(rules, "seq"), key="user", order="seq", action="action")
    assert got(last, "user", "action") == [("Bob", "order")]


def test_rule_in_force_when_the_action_arrives(spark):
    actions = spark.createDataFrame([(1, "u", "login"), (3, "u", "pay"), (4, "u", "login"), (6, "u", "order"), (7, "u", "pay")], "seq bigint, user string, action string")
    rules = spark.createDataFrame([(2, "login", "pay"), (6, "login", "order")], "seq bigint, action1 string, action2 string")
    for limit in (100, 2):
        found = joins.match_rules_in_force(actions, rules, key="user", order="seq", action="action", slice_rows=limit)
        assert got(found, "seq", "action1", "action2") == [(3, "login", "pay"), (6, "login", "order")]


def test_order_within_a_minute(spark):
    data = [
        ("A001", "order", 1000), ("A002", "order", 2000), ("A001", "other", 3000), ("A001", "payment", 4000),
        ("A002", "payment", 6000), ("A003", "order", 3000), ("A004", "order", 0), ("A004", "payment", 60_000),
    ]
    events = timed(spark, data, "key string, status string, ms bigint")
    found = patterns.followed_by_within(
        events, key="key", order="ms", ts="ts", first=F.col("status") == "order",
        second=F.col("status") == "payment", within="60 seconds", keep="ms",
    )
    assert got(found, "key", "status", F.coalesce(F.unix_millis("end_ts"), F.lit(-1))) == [
        ("A001", "matched", 4000), ("A002", "matched", 6000), ("A003", "timeout", -1), ("A004", "timeout", -1)
    ]


def test_consecutive_failures(spark):
    data = [("u", i, s) for i, s in enumerate("ffff")] + [("v", i, s) for i, s in enumerate("ffsf")]
    logins = spark.createDataFrame(data, "user string, seq bigint, status string")
    fail = F.col("status") == "f"
    steps = [("first", fail), ("second", fail), ("third", fail)]
    strict = patterns.strict_sequence(logins, key="user", order="seq", steps=steps, keep="seq")
    assert got(strict, "user", "first.seq", "third.seq") == [("u", 0, 2), ("u", 1, 3)]
    times = patterns.consecutive_times(logins, key="user", order="seq", condition=fail, times=3, value="seq")
    assert got(times, "user", "values") == [("u", [0, 1, 2]), ("u", [1, 2, 3])]


def test_count_trigger_average(spark):
    events = spark.createDataFrame([("u", i * 1000) for i in range(1, 13)], "user string, ms bigint")
    found = aggregates.every_nth_avg(events, key="user", order="ms", value=F.col("ms"), size=5)
    assert got(found, "round", "avg_value") == [(0, 3000), (1, 9000)]


def test_cumulate(spark):
    for at, ends in ((1000, [2, 4, 6, 8, 10]), (3999, [4, 6, 8, 10]), (8000, [10])):
        found = windows.cumulate(timed(spark, [("a", at)]), ts="ts", size="10 seconds", step="2 seconds", key="key")
        assert got(found, F.unix_millis("window_end")) == [(e * 1000,) for e in ends]


def test_session_joins_rows_exactly_one_gap_apart(spark):
    found = windows.session(timed(spark, [("a", t) for t in (0, 2000, 4001, 4500)]), ts="ts", gap="2 seconds", key="key")
    assert got(found, F.unix_millis("window_start"), F.unix_millis("window_end"), "cnt") == [(0, 4000, 2), (4001, 6500, 2)]


def test_session_of_a_hot_key(spark):
    data = [("hot", t * t % 50_000) for t in range(300)] + [("b", 5)]
    plain = windows.session(timed(spark, data), ts="ts", gap="1 second", key="key")
    cut = windows.session(timed(spark, data), ts="ts", gap="1 second", key="key", slice_rows=5)
    columns = ("key", F.unix_millis("window_start"), F.unix_millis("window_end"), "cnt")
    assert got(cut, *columns) == got(plain, *columns)


def test_hop_counts_every_row_size_over_slide_times(spark):
    found = windows.hop(timed(spark, LEFT), ts="ts", size="10 seconds", slide="2 seconds", key="key", measures=rows("n"))
    assert found.agg(F.sum("n")).first()[0] == 5 * len(LEFT)


def test_top_n_gives_what_exists(spark):
    counts = spark.createDataFrame([("w", "a", 3), ("w", "b", 3), ("w", "c", 1), ("x", "a", 1)], "w string, k string, n int")
    top = ranking.rank_within(counts, group="w", by="n", tie="k", n=2)
    assert got(top, "w", "rank", "k") == [("w", 1, "a"), ("w", 2, "b"), ("x", 1, "a")]
    low = ranking.rank_within(counts, group="w", by="n", tie="k", n=1, descending=False)
    assert got(low, "w", "k") == [("w", "c"), ("x", "a")]


def test_state_forms(spark):
    events = timed(spark, [("a", 0), ("a", 5000), ("a", 20_000)]).withColumn("v", F.col("ms").cast("string"))
    seen = state.previous_with_ttl(events, key="key", order="ms", ts="ts", value="v", ttl="10 seconds")
    assert got(seen, "ms", F.coalesce("prev_v", F.lit("-"))) == [(0, "-"), (5000, "0"), (20_000, "-")]
    assert got(state.history_length(events, key="key", order="ms"), "ms", "history_len") == [(0, 1), (5000, 2), (20_000, 3)]
    recent = state.recent_history(events, key="key", order="ms", value="v", length=2)
    assert got(recent, "history") == [(["0"],), (["0", "5000"],), (["5000", "20000"],)]
    fired = timer_firings(timed(spark, [("a", 1), ("a", 1), ("b", 1)]), key="key", ts="ts", after="10 seconds")
    assert got(fired, "key", F.unix_millis("fires_at")) == [("a", 10_001), ("b", 10_001)]


def units_hash(text):
    units, h = text.encode("utf-16-be"), 0
    for i in range(0, len(units), 2):
        h = (31 * h + (units[i] << 8) + units[i + 1]) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def test_string_hash_agrees_in_all_forms(spark):
    texts = ["Catalina", "Josh", "", "héllo wörld", "日本語", "a😀b", "x" * 300]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    register_functions(spark)
    df.createOrReplaceTempView("texts")
    native = dict(got(df, "s", string_hash("s")))
    assert native["Catalina"] == 111604187 and native["Josh"] == 2314874 and native[""] == 0
    assert native == {t: units_hash(t) for t in texts}
    sql = spark.sql("SELECT s, string_hash(s) a, string_hash(s) b FROM texts")
    assert {r["s"]: r["a"] for r in sql.collect()} == native == {r["s"]: r["b"] for r in sql.collect()}


def test_table_function_and_split(spark):
    register_functions(spark)
    assert got(spark.sql("SELECT word, length FROM split_lengths('home?id=1')"), "word", "length") == [("home", 4), ("id=1", 4)]
    urls = spark.createDataFrame([("home?id=1",), (None,)], "url string")
    assert got(joins.lateral_split(urls, "url"), "word", "length") == [("home", 4), ("id=1", 4)]
    ended = spark.createDataFrame([("home?",), ("a??b??",), ("??",), ("",)], "url string")
    want = [("", 0), ("", 0), ("a", 1), ("b", 1), ("home", 4)]
    assert got(joins.lateral_split(ended, "url"), "word", "length") == want
    ended.createOrReplaceTempView("ended")
    assert got(spark.sql("SELECT T.word, T.length FROM ended, LATERAL split_lengths(url) AS T"), "word", "length") == want
    assert [r[0] for r in ended.select(split_text("url", "?")).collect()] == [["home"], ["a", "", "b"], None, [""]]


def test_weighted_average_is_null_without_weight(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 5, 2), ("b", 7, 0)], "k string, v bigint, w bigint")
    found = df.groupBy("k").agg(weighted_avg("v", "w").alias("x"))
    assert {r["k"]: r["x"] for r in found.collect()} == {"a": 4, "b": None}


def test_records_are_parsed_or_rejected(spark):
    lines = spark.createDataFrame(
        [("Mary, ./home, 1000",), ("Bob,./cart,2000L",), ("broken",), ("a,b,c",), ("a,b,1,d",)], "value string"
    )
    parsed = parse_records(lines)
    assert got(accepted(parsed), "username", "url", "timestamp") == [("Bob", "./cart", 2000), ("Mary", "./home", 1000)]
    assert got(rejected(parsed), "reject") == [("a,b,1,d",), ("a,b,c",), ("broken",)]


def test_csv_table_rows_by_name_and_type(spark):
    """Invented rows: a quoted separator, an empty field, an umlaut and a number that is none."""
    path = shared_folder(spark, "visits")
    lines = ['Ines,"/a,b",17L', "Örn,,250L", "Ines,/c,9L", "Örn,/c,none"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    table = csv_table(spark, path, "visitor string, page string, at string", view="visits")
    found = spark.sql("SELECT page FROM visits WHERE visitor = 'Ines'")
    assert got(found, "page") == [("/a,b",), ("/c",)]
    assert got(aggregates.count_by(table, "visitor"), "visitor", "cnt") == [("Ines", 2), ("Örn", 2)]
    assert got(table.filter("page = '/c'").select(F.coalesce(parse_long("at"), F.lit(-1)).alias("ms")), "ms") == [(-1,), (9,)]


def test_table_attributes_and_text(spark):
    clicks = literal_rows(spark, [("Mary", "./home", 1500)], CLICK)
    table = as_table(clicks, ["username", "timestamp"], rename={"timestamp": "ts"}, rowtime=("timestamp", "et"), delay="1 second", proctime="pt")
    assert schema_text(table).splitlines() == ["username string", "ts bigint", "et timestamp", "pt timestamp"]
    shown = clicks.select(event_text("username", "url", "timestamp").alias("t"), timestamp_text(F.lit(1000)).alias("u"))
    assert got(shown, "t", "u") == [
        ("Event{username='Mary', url='./home', timestamp=1970-01-01 00:00:01.5}", "1970-01-01 00:00:01.0")
    ]
    assert got(clicks.select(window_start_ms("timestamp", 1000).alias("s")), "s") == [(1000,)]


def test_hop_gives_the_same_by_panes_and_built_in(spark):
    data = timed(spark, [("k%d" % (i % 3), i * i * 37 % 60_000) for i in range(200)])
    columns = ("key", F.unix_millis("window_start"), F.unix_millis("window_end"), "cnt")
    found = [windows.hop(data, ts="ts", size="10 seconds", slide="2 seconds", key="key", panes=p) for p in (True, False)]
    assert got(found[0], *columns) == got(found[1], *columns)
