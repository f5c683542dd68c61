"""Print the physical plan of registered queries. Usage: python tools/explain.py DIR query ..."""

import pathlib
import sys

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from lakeloom.plans.catalog import REGISTRY  # noqa: E402
from lakeloom.session import get_spark  # noqa: E402

spark = get_spark("explain", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false", spark_ui_showConsoleProgress="false")
spark.sparkContext.setLogLevel("ERROR")
for name in sys.argv[2:]:
    print(f"===== {name}")
    REGISTRY[name](spark, sys.argv[1]).explain()
