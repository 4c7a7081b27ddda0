"""Object-store (S3A) settings, global or for one bucket.

Returned as a dict of ``spark.hadoop.fs.s3a.*`` settings; nothing is set
unless an endpoint is given, as in the reference.
"""

from __future__ import annotations


def s3a_settings(
    endpoint: str | None,
    access_key: str | None = None,
    secret_key: str | None = None,
    *,
    path_style_access: bool = True,
    bucket: str | None = None,
) -> dict[str, str]:
    if not endpoint:
        return {}
    prefix = f"spark.hadoop.fs.s3a.bucket.{bucket}" if bucket else "spark.hadoop.fs.s3a"
    settings = {
        f"{prefix}.endpoint": endpoint,
        f"{prefix}.path.style.access": str(bool(path_style_access)).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    if access_key is not None:
        settings[f"{prefix}.access.key"] = access_key
    if secret_key is not None:
        settings[f"{prefix}.secret.key"] = secret_key
    return settings
