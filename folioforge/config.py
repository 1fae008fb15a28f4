"""Settings from the environment: one URL, or its parts."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from dataclasses import dataclass
from urllib.parse import quote, urlsplit


@dataclass(frozen=True)
class Database:
    url: str
    user: str | None = None
    password: str | None = None

    @classmethod
    def from_env(cls, prefix: str, scheme: str, port: int, env: dict | None = None) -> Database | None:
        """<prefix>_URL, else <prefix>_HOST, _PORT, _DATABASE, _USER, _PASSWORD; None if neither is set."""
        env = os.environ if env is None else env
        whole = env.get(f"{prefix}_URL")
        if whole:
            p = urlsplit(whole)
            return cls(f"jdbc:{scheme}://{p.hostname}:{p.port or port}{p.path}", p.username, p.password)
        host = env.get(f"{prefix}_HOST")
        if not host:
            return None
        return cls(f"jdbc:{scheme}://{host}:{env.get(f'{prefix}_PORT', port)}/{quote(env.get(f'{prefix}_DATABASE', ''))}", env.get(f"{prefix}_USER"), env.get(f"{prefix}_PASSWORD"))

    def options(self, table: str) -> dict[str, str]:
        """Options of Spark's jdbc source and sink."""
        out = {"url": self.url, "dbtable": table, "user": self.user, "password": self.password}
        return {k: v for k, v in out.items() if v is not None}


@dataclass(frozen=True)
class ObjectStore:
    """An S3-compatible store; paths under it are s3a:// paths that Spark's readers and writers take."""

    bucket: str
    endpoint: str | None = None
    key: str | None = None
    secret: str | None = None

    @classmethod
    def from_env(cls, prefix: str = "S3", env: dict | None = None) -> ObjectStore:
        """<prefix>_BUCKET, _ENDPOINT, _KEY_ID and _KEY_SECRET; without a bucket a ValueError."""
        env = os.environ if env is None else env
        if not env.get(f"{prefix}_BUCKET"):
            raise ValueError(f"{prefix}_BUCKET is not set")
        return cls(env[f"{prefix}_BUCKET"], env.get(f"{prefix}_ENDPOINT"), env.get(f"{prefix}_KEY_ID"), env.get(f"{prefix}_KEY_SECRET"))

    def path(self, *parts: str) -> str:
        return "/".join([f"s3a://{self.bucket}", *(p.strip("/") for p in parts if p.strip("/"))])

    def settings(self) -> dict[str, str]:
        """Settings of a session, for this bucket alone."""
        at = f"spark.hadoop.fs.s3a.bucket.{self.bucket}"
        out = {f"{at}.endpoint": self.endpoint, f"{at}.access.key": self.key, f"{at}.secret.key": self.secret, f"{at}.path.style.access": "true" if self.endpoint else None}
        return {k: v for k, v in out.items() if v is not None}


def scratch(spark) -> str:
    """A new path in the folder that all executors share, spark.checkpoint.dir.

    Without that setting only a session in one process gets a folder, which goes with it; a
    cluster is refused, as its executors share no local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="folioforge-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        base = f"file://{own}"
    return f"{base}/{uuid.uuid4().hex}"
