"""Members of archives as rows, a task for each archive."""

from __future__ import annotations

import gzip
import io
import tarfile
import zipfile
import zlib
from collections.abc import Iterator

from pyspark.sql.functions import udtf


@udtf(returnType="name string, content binary, error string")
class Members:
    """Files in a ZIP or a tar (plain, gz, bz2), without folders.

    A broken archive gives the members that can be read, then a row that says what is wrong; so does
    a member that cannot be read.
    """

    def eval(self, content: bytes) -> Iterator[tuple[str | None, bytes | None, str | None]]:
        raw = bytes(content or b"")
        if zipfile.is_zipfile(io.BytesIO(raw)):
            with zipfile.ZipFile(io.BytesIO(raw)) as archive:
                for item in archive.infolist():
                    if not item.is_dir():
                        try:
                            yield item.filename, archive.read(item), None
                        except (zipfile.BadZipFile, zlib.error, EOFError) as wrong:
                            yield item.filename, None, f"zip: {wrong}"
            return
        try:
            with tarfile.open(fileobj=io.BytesIO(raw)) as archive:
                for item in archive:
                    if item.isfile():
                        yield item.name, archive.extractfile(item).read(), None
        except (tarfile.TarError, EOFError, OSError, zlib.error) as wrong:
            yield None, None, f"archive: {wrong}"


def zipped(files: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in files.items():
            archive.writestr(name, content)
    return out.getvalue()


def unzipped_text(content: bytes) -> str:
    return gzip.decompress(content).decode("utf-8")
