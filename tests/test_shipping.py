"""Functions sent to executors must load where neither package can be imported."""

import base64
import subprocess
import sys

from pyspark import cloudpickle

from estatelake.functions.html import Pick, _Page


def test_code_travels_with_its_functions(tmp_path):
    shipped = base64.b64encode(cloudpickle.dumps((Pick, _Page))).decode()
    script = (
        "import sys, base64; from pyspark import cloudpickle\n"
        "pick, page = cloudpickle.loads(base64.b64decode(sys.stdin.read()))\n"
        "assert page('<p>x').tag == ['p', None] and pick.__name__ == 'Pick'\n"
        "assert 'drives' not in sys.modules and 'estatelake' not in sys.modules\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", script], input=shipped, cwd=tmp_path, capture_output=True, text=True, timeout=60
    )
    assert done.returncode == 0, done.stderr
