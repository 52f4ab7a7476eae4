from pyspark.sql import functions as F

from txguard import schemas


def tx_frame(spark, rows, more=""):
    """Transactions from dicts; fields not given are null. All values may be text."""
    ddl = schemas.TRANSACTION
    text = ", ".join(f"{n} string" for n in schemas.field_names(ddl))
    names = schemas.field_names(ddl)
    frame = spark.createDataFrame(
        [tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in rows], text
    )
    return frame.select(*[F.col(f.name).cast(f.dataType) for f in schemas.struct(ddl)])


def by(df, key, *columns):
    """{key: row values} of a small frame."""
    return {
        r[key]: (r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns))
        for r in df.collect()
    }


def plan(df):
    return df._jdf.queryExecution().toString()


def executed(df):
    """The plan after the query ran, with what adaptive execution made of it."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def same_rows(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = a.select(columns), b.select(columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


_results = {}


def result(queries, name, spark, sf):
    """The frame of a query, built once per session: streams and tables behind it are run and written once."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _results:
        _results[key] = queries[name](spark, sf)
    return _results[key]
