"""Publishing tables as single files: staged, hashed, moved into place at once."""

from __future__ import annotations

import csv
import hashlib
import io
import os
import re
import shutil
import stat
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame

from ..errors import FlowError
from ..shared import shared_folder
from ..sources.catalog import Secrets, SftpConnection
from ..types import column
from .store import copy_into, digest_of, names_in, remove, replace, store_of

COMPONENT = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


@dataclass(frozen=True)
class Manifest:
    archivo: str
    bytes: int
    sha256: str
    filas: int | None
    estado: str
    timestamp: str

    def as_dict(self) -> dict:
        return asdict(self)


def now() -> str:
    return datetime.now(UTC).isoformat()


class Staging:
    """Private folders that are used once."""

    def __init__(self, root: str | None = None):
        self.root = Path(root or tempfile.mkdtemp(prefix="flow-staging-"))
        self.root.mkdir(parents=True, exist_ok=True, mode=0o700)

    def folder(self, name: str) -> Path:
        if not COMPONENT.fullmatch(name):
            raise FlowError(f"Nombre de staging inválido: {name!r}", "STAGING_INVALID")
        path = self.root / name
        if path.exists():
            raise FlowError(f"El staging {name} ya se usó", "STAGING_REUSED")
        path.mkdir(mode=0o700)
        if stat.S_IMODE(path.stat().st_mode) != 0o700:
            path.chmod(0o700)
        return path

    def remove(self) -> None:
        shutil.rmtree(self.root, ignore_errors=True)


class CsvWriter:
    """Rows to a CSV with byte order mark and CRLF; opens the file with the first row."""

    def __init__(self, path: Path, header: list[str]):
        self.path, self.header, self.file, self.rows = path, header, None, 0

    def write(self, rows: Iterable[Iterable]) -> None:
        for row in rows:
            if self.file is None:
                self.file = self.path.open("w", encoding="utf-8-sig", newline="")
                self.out = csv.writer(self.file, lineterminator="\r\n", quoting=csv.QUOTE_MINIMAL)
                self.out.writerow(self.header)
            self.out.writerow(row)
            self.rows += 1

    def close(self) -> None:
        if self.file:
            self.file.close()


def digest(path: Path) -> str:
    out = hashlib.sha256()
    with path.open("rb") as file:
        while block := file.read(1 << 20):
            out.update(block)
    return out.hexdigest()


@contextmanager
def csv_parts(df: DataFrame) -> Iterator[list[str]]:
    """The rows as CSV without header, written by tasks into the shared folder: the parts' addresses in the rows' order, which are deleted at the end."""
    spark = df.sparkSession
    folder = shared_folder(spark, "publish")
    plain = df.select(*[column(c).cast("string").alias(c) for c in df.columns])
    options = {"emptyValue": "", "nullValue": "", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    try:
        plain.write.options(**options).csv(folder)
        yield [f"{folder}/{n}" for n in names_in(spark, folder) if n.startswith("part-")]
    finally:
        remove(spark, folder)


def head_of(names: list[str]) -> bytes:
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerow(names)
    return out.getvalue().encode()


def single_csv(df: DataFrame, target: Path) -> None:
    """One CSV with header on the driver's disk: the bytes of the parts that tasks wrote are put together through Hadoop's file systems."""
    spark = df.sparkSession
    with csv_parts(df) as parts:
        target.write_bytes(head_of(df.columns))
        java = spark._jvm.java.io.FileOutputStream(str(target.resolve()), True)
        try:
            for part in parts:
                copy_into(spark, java, part)
        finally:
            java.close()


def publish_store(df: DataFrame, target: str) -> Manifest:
    """One CSV with header at an address of any store: put together beside the target, then moved into place at once; a target with other content is never replaced."""
    spark, partial = df.sparkSession, f"{target}.partial"
    where, files = store_of(spark, partial)
    with csv_parts(df) as parts:
        out = files.create(where, True)
        try:
            out.write(bytearray(head_of(df.columns)))
            for part in parts:
                copy_into(spark, out, part)
        finally:
            out.close()
    size, mine = digest_of(spark, partial)
    there = digest_of(spark, target)
    if there and there[1] != mine:
        files.delete(where, False)
        raise FlowError(f"El destino existe con otro contenido: {target.rsplit('/', 1)[-1]}", "PUBLISH_CONFLICT")
    replace(spark, partial, target)
    return Manifest(target.rsplit("/", 1)[-1], size, mine, None, "PUBLICADO", now())


def promote(staged: Path, target: Path) -> Manifest:
    """Move a staged file into place at once; a target with other content is never replaced."""
    target.parent.mkdir(parents=True, exist_ok=True)
    mine = digest(staged)
    if target.exists() and digest(target) != mine:
        raise FlowError(f"El destino existe con otro contenido: {target.name}", "PUBLISH_CONFLICT")
    partial = target.with_name(target.name + ".partial")
    shutil.copyfile(staged, partial)
    if digest(partial) != mine:
        partial.unlink()
        raise FlowError("La copia no coincide", "PUBLISH_CORRUPT")
    os.replace(partial, target)
    return Manifest(target.name, target.stat().st_size, mine, None, "PUBLICADO", now())


def publish_local(df: DataFrame, target: Path, staging: Staging, name: str) -> Manifest:
    staged = staging.folder(name) / "part-00000.csv"
    single_csv(df, staged)
    return promote(staged, target)


def publish_sftp(df: DataFrame, connection: SftpConnection, path: str, secrets: Secrets, staging: Staging, name: str, connect=None) -> Manifest:
    """Upload as .partial, check the size, then rename; an existing file is kept aside until the new one is in place.

    connect(connection, secrets) gives an SFTP client; by default paramiko's, which must be installed.
    """
    staged = staging.folder(name) / "part-00000.csv"
    single_csv(df, staged)
    client = (connect or paramiko_client)(connection, secrets)
    target, size = f"{connection.base.rstrip('/')}/{path}", staged.stat().st_size
    partial, backup = f"{target}.partial", f"{target}.backup"
    try:
        client.put(str(staged), partial)
        if client.stat(partial).st_size != size:
            raise FlowError("La subida quedó incompleta", "PUBLISH_CORRUPT")
        try:
            client.posix_rename(partial, target)
        except OSError:  # a server without the extension
            kept = True
            try:
                client.rename(target, backup)
            except OSError:
                kept = False
            try:
                client.rename(partial, target)
            except OSError as e:
                if kept:
                    client.rename(backup, target)
                raise FlowError("No se pudo publicar por SFTP", "PUBLISH_FAILED") from e
            if kept:
                client.remove(backup)
    finally:
        client.close()
    return Manifest(path.rsplit("/", 1)[-1], size, digest(staged), None, "PUBLICADO", now())


def paramiko_client(connection: SftpConnection, secrets: Secrets):
    try:
        import paramiko
    except ImportError as e:
        raise FlowError("SFTP necesita paramiko", "SFTP_UNAVAILABLE") from e
    import base64
    import io

    ssh = paramiko.SSHClient()
    if connection.known_hosts:
        ssh.load_host_keys(connection.known_hosts)
    else:
        ssh.load_system_host_keys()
    ssh.set_missing_host_key_policy(paramiko.RejectPolicy())
    password = secrets.require(connection.secret) if connection.secret else None
    user = connection.user
    if not user and password and ":" in password:
        user, password = password.split(":", 1)
    options = {"username": user, "port": connection.port}
    if connection.key_secret:
        options["pkey"] = paramiko.RSAKey.from_private_key(io.StringIO(base64.b64decode(secrets.require(connection.key_secret)).decode()))
    elif connection.key_file:
        options["key_filename"] = connection.key_file
    elif password:
        options["password"] = password
    ssh.connect(connection.host, **options)
    return ssh.open_sftp()
