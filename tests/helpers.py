from datetime import UTC, datetime, timedelta

T0 = datetime(2026, 5, 18, 12, 0, tzinfo=UTC)


def at(minutes=0, seconds=0):
    return T0 + timedelta(minutes=minutes, seconds=seconds)


def long_rows(spark, rows):
    """(time, metric, value[, pod_uid[, node]]) -> a long frame."""
    from failcast.schema import LONG_SCHEMA

    full = []
    for r in rows:
        uid = r[3] if len(r) > 3 else "uid-1"
        full.append((r[0], r[1], r[2], "workloads", "p", uid, "c", r[4] if len(r) > 4 else "node-1"))
    return spark.createDataFrame(full, LONG_SCHEMA)
