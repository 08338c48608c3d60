import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)


@pytest.fixture(scope="session")
def spark():
    from tonnage.session import session

    conf = {"spark__sql__shuffle__partitions": "4", "spark__ui__enabled": "false", "spark__ui__showConsoleProgress": "false", "spark__driver__memory": "4g"}
    s = session("local[4]", **conf)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
