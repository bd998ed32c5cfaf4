import os
import subprocess
import sys
import tempfile

from freightlens.plans.materialize import app_folder, remove_tables, write_checkpoint_table


def test_tables_lie_in_one_folder_that_can_be_removed(spark):
    df = write_checkpoint_table(spark.range(5).toDF("a"), "numbers")
    folder = app_folder(spark).removeprefix("file:")
    assert df.count() == 5 and [f for f in os.listdir(folder) if f.startswith("numbers-")]
    if len(os.listdir(folder)) == 1:  # other tests may still need theirs
        remove_tables(spark)
        assert not os.path.exists(folder)


def test_nothing_is_left_when_the_application_ends():
    base = tempfile.mkdtemp(prefix="fl-exit-")
    code = ("from freightlens.session import get_session\n"
            "from freightlens.plans.materialize import write_checkpoint_table\n"
            f"s = get_session('local[1]', extra={{'spark.checkpoint.dir': {base!r}}})\n"
            "write_checkpoint_table(s.range(3).toDF('a'), 't').count()\n"
            "s.stop()\n")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert os.listdir(os.path.join(base, "freightlens")) == []
