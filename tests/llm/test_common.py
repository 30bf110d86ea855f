from pyspark.sql import functions as F

from stationlake.llm.common import with_marks


def test_no_row_with_a_partner_is_left_unmarked(spark):
    rows = spark.range(-3000, 3000).selectExpr("id AS k", "cast(id AS string) AS marks")
    wanted = spark.range(-9000, 9000, 7).selectExpr("id * id AS other", "id AS k")
    found = with_marks(rows, wanted, "k")
    assert found.columns == ["k", "marks", "marked"] and found.count() == 6000
    partners = {r.k for r in wanted.select("k").collect()}
    marked = {r.k for r in found.where("marked").collect()}
    assert {k for k in partners if -3000 <= k < 3000} <= marked
    assert len(marked - partners) < 30
    assert with_marks(rows, wanted.where(F.lit(False)), "k").where("marked").isEmpty()
