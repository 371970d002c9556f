import datetime as dt

from adfunnel import schema


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def event(event_id, sec, expid, tn, sid, sn=0, uid=None, ipint=None, sz=1, ref=None, bref=None, geo=7, bt=2):
    """A full 22-column event row (plus event_id) with recognisable payload."""
    row = {c: (0.0 if isinstance(t, schema.T.DoubleType) else "" if isinstance(t, schema.T.StringType) else 0)
           for c, t in schema.EVENT_FIELDS}
    row.update(uid=uid if uid is not None else 1000 + event_id, sec=ts(sec) if isinstance(sec, str) else sec,
               expid=expid, tn=tn, sn=sn, sid=sid, sz=sz, geo=geo, bt=bt,
               ipint=ipint if ipint is not None else 3232235520 + event_id,
               ref=ref if ref is not None else f"http://www.site{sid}.example/p{event_id}",
               bref=bref if bref is not None else f"http://back{event_id}.example/")
    return {"event_id": event_id, **row}


def frame(spark, rows):
    fields = [schema.T.StructField("event_id", schema.T.LongType())] + list(schema.EVENT_SCHEMA.fields)
    st = schema.T.StructType(fields)
    return spark.createDataFrame([tuple(r[f.name] for f in fields) for r in rows], st)


def ssp_frame(spark, sids):
    return spark.createDataFrame([(int(s), f"ssp{s}") for s in sids], "sid bigint, name string")


def plan_text(df) -> str:
    """The executed physical plan, untruncated (AQE: the initial plan)."""
    return df._jdf.queryExecution().executedPlan().toString()
