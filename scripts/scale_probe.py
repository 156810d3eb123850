"""Scaling probe: time the whole pipeline (unstaged, one plan) on the given tables and on a
k-fold copy that Spark derives from them (keys offset per copy, so persons, orders and stays
multiply too). Usage: python scripts/scale_probe.py <sf_dir> <scratch_dir> [k]"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from traitflow.plans import bindings as B  # noqa: E402
from traitflow.plans import pipeline as P  # noqa: E402
from traitflow.session import get_spark, sizing_conf  # noqa: E402


def replicate(spark, sf, out, k):
    od = spark.read.parquet(f"{sf}/orders.parquet")
    off_o, off_c = od.agg(F.max("o_orderkey") + 1, F.max("o_custkey") + 1).first()  # two scalars
    copies = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_i")
    parts = 4 * k   # several files, as real extracts are (the given tables are one row group each)
    (od.select("*", copies).withColumn("o_orderkey", F.col("o_orderkey") + F.col("_i") * off_o)
     .withColumn("o_custkey", F.col("o_custkey") + F.col("_i") * off_c).drop("_i")
     .repartition(parts).write.mode("overwrite").parquet(f"{out}/orders.parquet"))
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    (li.select("*", copies).withColumn("l_orderkey", F.col("l_orderkey") + F.col("_i") * off_o).drop("_i")
     .repartition(parts).write.mode("overwrite").parquet(f"{out}/lineitem.parquet"))
    cu = spark.read.parquet(f"{sf}/customer.parquet")
    (cu.select("*", copies).withColumn("c_custkey", F.col("c_custkey") + F.col("_i") * off_c).drop("_i")
     .repartition(parts).write.mode("overwrite").parquet(f"{out}/customer.parquet"))


def timed(spark, d):
    t0 = time.time()
    out = P.quant_pipeline(B.readings(spark, d), B.stays(spark, d), B.traits(spark), B.aliases(spark),
                           B.units(spark), B.linkage(spark, d), B.questionnaire(spark, d), B.AS_OF)
    out.write.format("noop").mode("overwrite").save()
    rows = spark.read.parquet(f"{d}/lineitem.parquet").count()
    return rows, round(time.time() - t0, 2)


def main():
    sf, scratch = sys.argv[1], sys.argv[2]
    k = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    cpus = 8
    total = sum(os.path.getsize(os.path.join(sf, f)) for f in os.listdir(sf)) * k
    spark = get_spark(f"local[{cpus}]", extra_conf={"spark.driver.memory": "16g",
                                                    "spark.ui.showConsoleProgress": "false",
                                                    **sizing_conf(total, cpus)})
    big = f"{scratch}/x{k}"
    replicate(spark, sf, big, k)
    timed(spark, sf)  # warm-up
    r1, t1 = timed(spark, sf)
    rk, tk = timed(spark, big)
    print(json.dumps({"base_rows": r1, "base_sec": t1, "scaled_rows": rk, "scaled_sec": tk, "factor": k,
                      "time_ratio": round(tk / t1, 2)}))


if __name__ == "__main__":
    main()
