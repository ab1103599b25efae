import io
import sys
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def zip_bytes(entries, method=zipfile.ZIP_DEFLATED) -> bytes:
    """A ZIP of `(name, bytes or text)` pairs, in order."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", method) as zf:
        for name, body in entries:
            zf.writestr(name, body)
    return buffer.getvalue()


def device_xml(*records) -> str:
    """A document of `{field: text}` records."""
    body = "".join(
        "<device>" + "".join(f"<{k}>{v}</{k}>" for k, v in record.items()) + "</device>"
        for record in records
    )
    return f"<r><devices>{body}</devices></r>"


@pytest.fixture
def landing(tmp_path):
    """Function that lands one archive and returns the folder."""
    folder = tmp_path / "landing"
    folder.mkdir()

    def land(name, content):
        data = content if isinstance(content, bytes) else zip_bytes(content)
        (folder / name).write_bytes(data)
        return str(folder)

    land.folder = str(folder)
    return land
