"""Operators on workers that do not have the package."""

import os
import subprocess
import sys
import tempfile

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])  # for the driver alone
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate())
try:
    list(spark.range(1).mapInArrow(lambda it: (__import__("seriesflow") and b for b in it), "id bigint").collect())
except Exception as error:
    assert "No module named" in str(error)
else:
    raise AssertionError("the workers have the package")
from seriesflow.llm import fill_middle, page_text, perplexity, spelling
docs = spark.createDataFrame([(i, "some plain words of one more text " * 3 + str(i), "en") for i in range(30)],
                             "doc_id bigint, text string, lang string")
pages = spark.createDataFrame([(1, "http://a/b", "<p>x y</p>"), (2, None, None)], "page_id bigint, url string, html string")
assert perplexity.quality(docs).count() == 30
assert spelling.variants(docs).count() >= 0
assert page_text.extract(pages, ["page_id"]).count() == page_text.extract(pages, ["page_id"], known=-1).count() == 2
made = fill_middle.transform(docs, ["doc_id"])
assert fill_middle.restore(made, ["doc_id"]).count() == 30
"""


def test_operators_without_the_package_on_workers():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    folder = tempfile.mkdtemp(prefix="seriesflow-tests-")
    done = subprocess.run([sys.executable, "-c", SCRIPT, root, folder], cwd=folder, env=env, capture_output=True,
                          text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
