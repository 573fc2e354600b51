import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys; sys.path.insert(0, {root!r})
from gleaner.session import local_session, materialise, shared_dir
spark = local_session("named", "2", spark__checkpoint__dir={folder!r})
assert shared_dir(spark) == {folder!r}
print(materialise(spark.range(5), "x").inputFiles()[0])
"""


def test_named_folder_is_used(tmp_path):
    code = SCRIPT.format(root=str(ROOT), folder=str(tmp_path))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True)
    assert str(tmp_path) in out.stdout


def test_a_cluster_without_a_folder_is_an_error(spark):
    import pytest

    from gleaner import session

    class Context:
        master = "yarn"

        def getConf(self):  # noqa: N802
            return {}

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
