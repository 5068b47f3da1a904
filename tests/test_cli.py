import importlib
import json
import subprocess
import sys
from pathlib import Path

import pytest

from textloom.plans import cli


def test_parser():
    o = cli.parser().parse_args(["articles", "--termWords", "2", "in", "out"])
    assert (o.app, o.termWords, o.retainTop, o.ldaTopics, o.input, o.output) == ("articles", 2, 0.05, 50, "in", "out")
    assert (o.summaryTop, o.tags, o.stopwordFile, o.keepUncommented, o.strict) == (0.1, 100, "", False, False)
    assert cli.parser().parse_args(["articles", "--keepUncommented", "--strict", "--stopwordFile", "s", "in", "out"]).keepUncommented
    assert cli.parser().parse_args(["lda", "--k", "3", "a", "b"]).inputs == ["a", "b"]
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["unknown"])


def test_word_count_from_the_command_line(spark, tmp_path):
    (tmp_path / "in.txt").write_text("a b a\n")
    cli.main(["wordcount", str(tmp_path / "in.txt"), str(tmp_path / "out")])
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["a,2", "b,1"]


def test_lda_from_the_command_line(spark, tmp_path, capsys):
    (tmp_path / "in.txt").write_text("\n".join(["haus garten wasser haus"] * 9 + ["motor auto strasse"] * 9))
    cli.main(["lda", "--k", "2", "--maxIterations", "2", str(tmp_path / "in.txt")])
    said = capsys.readouterr().out
    assert "\thaus\t" in said and "n_docs: 18" in said and "training_seconds" in said


def test_entry_points():
    e = importlib.import_module("__spark_entry__")
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_without_the_training_data_subpackage(tmp_path):
    root = Path(__file__).parent.parent
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
sys.modules["textloom.llm"] = None
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("textloom.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
del sys.modules["textloom.llm"]
import __spark_entry__ as e, json
print(json.dumps(sorted(e.queries())))
"""
    names = json.loads(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert "word_count" in names and not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
