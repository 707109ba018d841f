from demandcast.llm.common import Scratch
from demandcast.llm.simhash import meetings


class Plans(Scratch):
    """Scratch that keeps the plan of each table it writes."""

    def __init__(self, spark):
        super().__init__(spark, "plans")
        self.kept = {}

    def write(self, df, name="step"):
        out = super().write(df, name)
        df.collect()
        self.kept.setdefault(name, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return out


def test_the_index_is_shuffled_once(spark):
    """The posting lists are counted and their members taken from one exchange."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fps = [(x << 40) | (x * 7919 % 65536) for x in range(300)] + [5, 6, 7]
        scratch = Plans(spark)
        met, heavy = meetings(spark.createDataFrame([(x,) for x in fps], "fp long"), scratch, 6)
        pairs = {(r["a"], r["b"]) for r in met.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    in_heavy = {}
    for r in heavy.collect():
        in_heavy.setdefault((r["set"], r["key"]), []).append(r["fp"])
    pairs |= {(a, b) for fps_of in in_heavy.values() for a in fps_of for b in fps_of if a < b}
    assert pairs >= {(a, b) for a in fps for b in fps if a < b and sum((a >> 8 * p & 255) == (b >> 8 * p & 255) for p in range(8)) >= 6}
    plan = scratch.kept["members"]
    assert "ReusedExchange" in plan and len([x for x in plan.splitlines() if "- Exchange " in x]) == 1, plan
