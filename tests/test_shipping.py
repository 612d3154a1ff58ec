import subprocess
import sys

from pyspark import cloudpickle

from lectern.functions.html import read_elements
from lectern.operators.chunking import split_recursively
from lectern.operators.embedding import HashedWords
from lectern.operators.generation import overlap_judge


def test_functions_carry_their_code(tmp_path):
    """Executors can run the package's functions without having the package."""

    def work():
        judged = overlap_judge()([{"content": '{"generated_answer": "a b", "reference_answer": "a b"}'}])
        found, page = read_elements("<section id=x>a<p>b</p></section>")
        return split_recursively("aa bb", 3, 0), found[0][3], page, judged[0], HashedWords(4).dim

    (tmp_path / "work.pkl").write_bytes(cloudpickle.dumps(work))
    code = (
        "import importlib.util, pickle\n"
        "assert importlib.util.find_spec('lectern') is None\n"
        "print(pickle.load(open('work.pkl', 'rb'))())"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin"})
    assert done.stdout.strip() == "(['aa', 'bb'], 'a\\nb', 'ab', '5', 4)", done.stderr
