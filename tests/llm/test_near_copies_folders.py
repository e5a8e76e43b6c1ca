"""What the search for near copies stores on its way is gone when it is done."""

from pyspark.sql import functions as F

from tidelog.functions.folders import begun
from tidelog.llm import near_copies
from tidelog.llm.common import qualified, shared_dir


def test_only_bands_stay(spark):
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(words[:k] + [f"x{k}"] + words[k + 1 :])) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    base = qualified(spark, shared_dir(spark))
    before = set(begun(spark, base))
    found = near_copies.near_copies(df).agg(F.countDistinct("doc_id"), F.min("component_id")).first()
    assert tuple(found) == (40, 0)
    new = {name.rsplit("-", 1)[0] for name in set(begun(spark, base)) - before}
    assert "shingle-bands" in new and not new & {"shingle-sets", "near-copies"}
