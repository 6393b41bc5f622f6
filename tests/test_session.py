"""Scopes of intermediate tables."""

import os
import threading

from rateweave.session import call_in_context, cut_lineage, in_context, intermediates


def path_of(df):
    return df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]


def test_scopes_side_by_side_keep_to_their_own_tables(spark):
    outer = path_of(cut_lineage(spark.range(3)))
    begun, ended, seen = threading.Event(), threading.Event(), {}

    def other():
        with intermediates(spark):
            table = cut_lineage(spark.range(5))
            seen["path"] = path_of(table)
            begun.set()
            ended.wait(60)
            seen["rows"] = table.count()                 # still there after the other job's scope has ended

    t = threading.Thread(target=other)
    t.start()
    begun.wait(60)
    with intermediates(spark):
        own = path_of(cut_lineage(spark.range(2)))
        with intermediates(spark):
            inner = path_of(cut_lineage(spark.range(1)))
        assert os.path.exists(own) and not os.path.exists(inner)
        (pooled,) = map(call_in_context, in_context(lambda n: path_of(cut_lineage(spark.range(n))), [4]))
        assert os.path.exists(pooled)
    assert not os.path.exists(own) and not os.path.exists(pooled) and os.path.exists(seen["path"]) and os.path.exists(outer)
    ended.set()
    t.join(60)
    assert seen["rows"] == 5 and not os.path.exists(seen["path"])
