"""The command line starts and lists its subcommands."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    return subprocess.run([sys.executable, "-m", "starloom", *args], cwd=ROOT, capture_output=True, text=True,
                          timeout=120)


def test_usage_lists_subcommands():
    r = _run()
    assert r.returncode == 2 and "etl" in r.stdout and "rules" in r.stdout and "sql" in r.stdout


def test_subcommand_help():
    for cmd in ("etl", "rules", "sql"):
        r = _run(cmd, "--help")
        assert r.returncode == 0, r.stderr
        assert "usage" in r.stdout
