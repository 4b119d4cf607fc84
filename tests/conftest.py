import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "3g")
        .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


ENTRY = "lang string, level string, list_id string, ord bigint, line int, lemma string, english string, chinese string, pos string"


@pytest.fixture(scope="session")
def entry(spark):
    """entry((lang, level, lemma, english, chinese, pos), …) as the entry relation, ord and line by place."""

    def make(*rows):
        full = [(r[0], r[1], f"{r[0]}-{r[1]}", i + 1, i + 2, *r[2:]) for i, r in enumerate(rows)]
        return spark.createDataFrame(full, ENTRY)

    return make


def rows_of(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
