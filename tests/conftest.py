import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from metricas.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def pages(spark):
    """Build landed pages: rows of (plataforma, pagina_id, endpoint, entity_id, variant, page_seq, payload[, run_id, run_date])."""
    from metricas import schemas as S

    def make(rows):
        data = [(*r[:6], json.dumps(r[6]), *(r[7:] or (None, None))) for r in rows]
        return spark.createDataFrame(data, S.LANDED_PAGE)
    return make
