"""URL expressions: host without ``www.`` and a fingerprint of the URL.

Host rule: drop the scheme and ``//`` and any user info; the host ends at
``/ : ? #``; lower-case; drop one leading ``www.``; a string without ``//``
has no host ('').  Built on ``regexp_extract`` so junk never raises (unlike
``parse_url`` under ANSI mode).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Host pattern and the trailing characters ignored by the fingerprint.
HOST_PATTERN = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)"
WWW_PATTERN = r"^www\."
FINGERPRINT_TRAILING = r"[/?#]$"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST_PATTERN, 1))


def domain_without_www(url: Column) -> Column:
    return F.regexp_replace(host(url), WWW_PATTERN, "")


def url_fingerprint(url: Column) -> Column:
    """md5 of the URL without one trailing ``/``, ``?`` or ``#``.

    Equal for URLs that differ only there; the digest value itself has no
    meaning beyond equality.
    """
    return F.md5(F.regexp_replace(url, FINGERPRINT_TRAILING, ""))
