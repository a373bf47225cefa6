import tempfile

import pytest

from verbalance.session import build_session


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="verbalance-tests-")
    session = build_session(
        "verbalance-tests",
        "local[4]",
        **{
            "spark_ui_enabled": "false",
            "spark_ui_showConsoleProgress": "false",
            "spark_sql_shuffle_partitions": "4",
            "spark_driver_memory": "4g",
            "spark_checkpoint_dir": f"{folder}/shared",
            "spark_sql_warehouse_dir": f"{folder}/warehouse",
            "spark_driver_extraJavaOptions": f"-Dderby.system.home={folder}",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)
