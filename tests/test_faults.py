"""Empty inputs, stored texts and work far from the repository."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from tidewatch.operators import contracts as K
from tidewatch.operators import evaluate as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_sweep_of_no_scores_is_empty(spark):
    none = spark.createDataFrame([], "y int, score double")
    assert E.percentile_sweep(none, "y", "score").count() == 0
    assert E.percentile_sweep(spark.createDataFrame([(1, None)], "y int, score double"), "y", "score").count() == 0


def test_justification_is_stored_without_blanks(spark):
    doc = spark.createDataFrame([('{"justification": "  long enough to tell \\n"}',)], "j string")
    got = doc.select(K.typed(F.parse_json("j"), K.TRIAGE)["justification"]).first()[0]
    assert got == "long enough to tell"


def test_python_in_tasks_runs_from_another_folder(tmp_path):
    """The workers get the package from the session, not from the folder the job was started in."""
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r})\n"
        "import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        f"s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').config('spark.checkpoint.dir', {str(tmp_path / 'shared')!r}).getOrCreate()\n"
        "print('ROWS', e.queries()['nearest_known'](s, '/root/testdata/sf0.001').count())\n"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "ROWS 500" in run.stdout, run.stderr[-2000:]
