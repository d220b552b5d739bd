"""The reference's own tests, re-expressed: preprocessing on a five-row frame
and a stratified 60/20/20 split of 100 seeded rows."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.operators import clean, split


def test_preprocess_label_and_encoding(spark):
    pdf = pd.DataFrame({
        "age": ["[0-10)", "[10-20)", "[20-30)", "[30-40)", "[40-50)"],
        "gender": ["Male", "Female", "Male", "Female", "Male"],
        "time_in_hospital": [1, 3, 5, 7, 9],
        "num_medications": [2, 4, 6, 8, 10],
        "readmitted": ["<30", ">30", "NO", "<30", ">30"],
    })
    df = spark.createDataFrame(pdf).withColumn("row", F.monotonically_increasing_id())
    c = clean.impute(clean.drop_sparse(clean.sentinel_to_null(df)))
    c = c.withColumn("readmitted_30d", fx.label_from("readmitted"))
    c = clean.encode_categories(c, ["age", "gender"])
    rows = c.orderBy("row").collect()
    assert [r["readmitted_30d"] for r in rows] == [1, 0, 0, 1, 0]
    assert dict(c.dtypes)["gender"] == "int"
    assert [r["gender"] for r in rows] == [1, 0, 1, 0, 1]     # Female=0, Male=1 (alphabetical)


def test_split_sizes_and_class_share(spark):
    rng = np.random.RandomState(42)
    n = 100
    pdf = pd.DataFrame({"id": np.arange(n), "feature1": rng.rand(n), "feature2": rng.rand(n),
                        "readmitted_30d": rng.choice([0, 1], size=n, p=[0.7, 0.3])})
    df = spark.createDataFrame(pdf)
    s = split.stratified_split(df, "readmitted_30d", "id").toPandas()
    sizes = s["split"].value_counts().to_dict()
    assert sizes == {"train": 60, "val": 20, "test": 20}
    whole = pdf["readmitted_30d"].mean()
    for part in ("train", "val", "test"):
        assert abs(s.loc[s.split == part, "readmitted_30d"].mean() - whole) <= 0.1
    # reproducible and disjoint
    s2 = split.stratified_split(df, "readmitted_30d", "id").toPandas()
    assert s.sort_values("id")["split"].tolist() == s2.sort_values("id")["split"].tolist()
    assert s["id"].nunique() == n


def test_kfold_balanced(spark):
    pdf = pd.DataFrame({"id": np.arange(50), "y": [1] * 10 + [0] * 40})
    f = split.kfold(spark.createDataFrame(pdf), "y", "id", k=5).toPandas()
    counts = f.groupby(["fold", "y"]).size().unstack()
    assert (counts[1] == 2).all() and (counts[0] == 8).all()
