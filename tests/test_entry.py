import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.columns == ["item", "user", "rank", "score", "p_name"] or set(df.columns) == {
        "item", "user", "rank", "score", "p_name"}
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_partition_count_does_not_change_results(spark):
    q = E.queries()["item_knn"]
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    a = sorted(map(tuple, q(spark, "/root/testdata/sf0.001").collect()), key=repr)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    b = sorted(map(tuple, q(spark, "/root/testdata/sf0.001").collect()), key=repr)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b
