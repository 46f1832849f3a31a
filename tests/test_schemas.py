from corvina import schemas


def test_every_record_type_parses(spark):
    for name in schemas.DDL:
        assert schemas.schema(name).names


def test_violations(spark):
    df = spark.createDataFrame([("1", "a", 0.5), ("2", None, 1.5), ("3", "z", None)], "id string, kind string, confidence double")
    got = sorted(tuple(r) for r in schemas.violations(df, "id", ["kind", "gone"], {"kind": ("a", "b")}, {"confidence": (0, 1)}).collect())
    assert got == [("1", "gone", "required"), ("2", "confidence", "range"), ("2", "gone", "required"), ("2", "kind", "required"), ("3", "gone", "required"), ("3", "kind", "enum")]
    assert schemas.violations(df, "id").count() == 0


def test_unknown_keys(spark):
    df = spark.createDataFrame([('{"pmid": "1", "odd": 2}',), ("not json",)], "value string")
    assert [r.path for r in schemas.unknown_keys(df, "papers").collect()] == ["odd"]
