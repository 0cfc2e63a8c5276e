import numpy as np
import pandas as pd

from tabforge.operators import knn


def test_donors_over_the_budget_are_met_as_pages(spark):
    rng = np.random.default_rng(4)
    cols = [f"x{i}" for i in range(20)]
    pdf = pd.DataFrame(rng.normal(size=(150, 20)), columns=cols)
    pdf.insert(0, "ID", np.arange(150))
    df = spark.createDataFrame(pdf)
    args = (df, df, cols, 4, "ID", "euclidean", True)
    over, under = (sorted(map(tuple, knn.knn_join(*args, strategy="broadcast", broadcast_budget=b).collect())) for b in (1000, 1 << 20))
    assert over == under and len(over) == 600
