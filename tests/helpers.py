import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldspark import schemas

WL_COLS = [f.name for f in schemas.WORKSTATION_LOG.fields]


def wl_rows(spark, rows):
    """Workstation log rows from dicts; unspecified columns are NULL / defaults."""
    base = {"id": None, "sn": "SN1", "pn": "PN1", "model": "Tesla SXM4", "workstation_name": "VI2",
            "history_station_start_time": None, "history_station_end_time": None,
            "history_station_passing_status": "Pass", "operator": "OP1", "customer_pn": None,
            "outbound_version": "V1", "hours": "1", "service_flow": "NORMAL", "passing_station_method": "AUTO",
            "first_station_start_time": None, "data_source": "workstation", "created_at": None}
    out = []
    for i, r in enumerate(rows):
        d = dict(base)
        d["id"] = i
        d.update(r)
        if isinstance(d["history_station_end_time"], str):
            d["history_station_end_time"] = dt.datetime.fromisoformat(d["history_station_end_time"])
        if d["history_station_start_time"] is None:
            d["history_station_start_time"] = d["history_station_end_time"]
        out.append(tuple(d[c] for c in WL_COLS))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schemas.WORKSTATION_LOG.fields])
    return spark.createDataFrame(out, schema)


def text_report(df, schema, skip=("id", "created_at", "data_source")):
    """Log rows as an exported report of text cells with human headers."""
    names = [f.name for f in schema.fields if f.name not in skip]
    return df.select(*[F.coalesce(F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSSSSS") if n.endswith("_time") else F.col(n),
                                  F.lit("")).alias(n.replace("_", " ").title()) for n in names])


def testboard_report(spark, sf_dir):
    from yieldspark.sources import fixtures as fx
    return text_report(fx.testboard_log(spark, sf_dir), schemas.TESTBOARD_LOG)


def snfn_report(spark, sf_dir):
    from yieldspark.sources import fixtures as fx
    return text_report(fx.snfn_log(spark, sf_dir), schemas.SNFN_LOG)
