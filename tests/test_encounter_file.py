"""How the encounter file and its reports are laid out."""

import __spark_entry__ as book

from carelake.testbed import star


def exchanges(node):
    own = [node.output().mkString(",")] if "Exchange" in node.nodeName() else []
    for i in range(node.children().size()):
        own += exchanges(node.children().apply(i))
    return own


def test_lines_are_shuffled_twice_at_most(spark, sf_dir):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(before, ("-1", "false")):
            spark.conf.set(k, v)
        plan = star.encounter_csv(spark, sf_dir)._jdf.queryExecution().executedPlan()
        of_lines = [columns for columns in exchanges(plan) if "l_orderkey" in columns]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(of_lines) == 2 and not any("c_custkey" in columns for columns in of_lines)


def test_all_reports_make_the_file_once(spark, sf_dir):
    result = book.queries()["i19_all_reports"](spark, sf_dir)
    assert result.count() == 18 and not any("lineitem" in f for f in result.inputFiles())
