from pyspark.sql import functions as F

from glossa.functions import scalars as S


def one(spark, expr, data, schema="v string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("o")).collect()]


def test_content_hash_matches_stored_reference_hash(spark):
    out = one(spark, S.content_hash("t", "vid"), [("Essere come il prezzemolo.", 1)], "t string, vid int")
    assert out == ["bd78bac4a7369d989abbf0fe6665c3a2b8e2138cae197e74f6a4ad144d11d793"]


def test_trim_ws_strips_unicode_whitespace(spark):
    out = one(spark, S.trim_ws("v"), [("  casa\t",), ("  ",), (None,), ("a b",)])
    assert out == ["casa", "", None, "a b"]


def test_split_ws_has_no_blank_pieces_and_splits_on_nbsp(spark):
    out = one(spark, S.split_ws("v"), [(" a b  c ",), ("",)])
    assert out == [["a", "b", "c"], []]


def test_first_piece(spark):
    assert one(spark, S.first_piece("v"), [("a?x",), ("?y",), ("b",)]) == ["a", "", "b"]


def test_normalize_iso_edge_cases(spark):
    data = [("IT",), ("it-it",), ("it_IT",), ("UND",), ("nap-IT",), ("EN-en",), ("fi",)]
    assert one(spark, S.normalize_iso("v"), data) == ["it-IT", "it-IT", "it_IT", "und", "nap-IT", "en-EN", "fi-FI"]
    assert one(spark, S.normalize_iso("v", strip_underscore=True), [("it_IT",)]) == ["it-IT"]


def test_strict_bool(spark):
    assert one(spark, S.strict_bool("v"), [(None,), (False,), (True,)], "v boolean") == [False, False, True]


def test_eligible_and_confidence_range(spark):
    df = spark.createDataFrame([(1, None), (1, 0.7), (1, 0.69), (1, 1.2), (None, 0.9)], "vid int, c double")
    rows = df.select(S.eligible("vid", "c").alias("e"), S.valid_confidence("c").alias("ok")).collect()
    assert [r.e for r in rows] == [None, True, False, True, False]  # NULL confidence: filter drops it
    assert [r.ok for r in rows] == [True, True, True, False, True]
    assert df.where(S.eligible("vid", "c")).count() == 2


def test_map_or_keep_and_asset_format(spark):
    assert one(spark, S.map_or_keep("v", {"n": "noun"}), [("n",), ("adj",), (None,)]) == ["noun", "adj", None]
    assert one(spark, S.asset_format("v"), [("audio",), ("image",)]) == ["mp3", "jpg"]


def test_json_object_keeps_nulls(spark):
    out = one(spark, S.json_object(a=F.col("v"), b=F.lit(None).cast("string")), [("x",)])
    assert out == ['{"a":"x","b":null}']


def test_not_admin_three_valued(spark):
    out = one(spark, S.not_admin("v"), [("admin",), ("student",), (None,)])
    assert out == [False, True, None]


def test_has_member(spark):
    out = one(spark, S.has_member("v", "b"), [(["a", "b"],), (["a"],), (None,)], "v array<string>")
    assert out == [True, False, None]


def test_scale_conf_sizes_partitions():
    from glossa.session import scale_conf
    c = scale_conf(100 * 10**12, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert int(scale_conf(10**6, 64)["spark.sql.shuffle.partitions"]) == 192


def test_broadcast_only_within_row_and_byte_limits(spark):
    from glossa.operators.dimensions import Size, checked_dimension, maybe_broadcast

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()

    dim, size = checked_dimension(spark.createDataFrame([(1, "a" * 100), (2, "b")], "k int, v string"))
    assert int(size) == 2 and size.bytes > 100
    assert hinted(maybe_broadcast(dim, size))
    assert not hinted(maybe_broadcast(dim, size, max_bytes=50))
    assert not hinted(maybe_broadcast(dim, Size(5, 10), max_rows=4))


def test_members_of_a_parsed_document(spark):
    texts = [('{"a": null, "b": {"c": 1}}',), ('{"a": "x"}',), ("{}",), ('{"a": ',), (None,)]
    assert one(spark, S.member_state(S.parsed("v"), "a"), texts) == ["null", "value", "missing", None, None]
    assert one(spark, S.variant_text(S.parsed("v"), "a"), texts) == [None, "x", None, None, None]
    assert one(spark, S.variant_text(S.parsed("v"), "b.c"), texts) == ["1", None, None, None, None]
