"""Downloads on the driver: one address, one file."""

from __future__ import annotations

from pathlib import Path
from urllib.parse import urlparse
from urllib.request import Request, urlopen

from ..functions.textnorm import CONTENT_TYPES, SUFFIXES

TIMEOUT = 30
AGENT = "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0 Safari/537.36"


def suffix_for(content_type: str, url: str) -> str:
    """As ``functions.textnorm.detect_extension``, for one address."""
    kind = content_type.split(";")[0].strip()
    if kind in CONTENT_TYPES:
        return CONTENT_TYPES[kind]
    own = Path(urlparse(url).path).suffix.lower()
    return ".html" if own == ".htm" or own not in SUFFIXES else own


def download(url: str, directory: str, open_url=urlopen) -> tuple[Path, str]:
    """(file, content type) of an address; redirects are followed, an error status raises."""
    with open_url(Request(url, headers={"User-Agent": AGENT}), timeout=TIMEOUT) as answer:
        body, kind, final = answer.read(), answer.headers.get("Content-Type", ""), answer.geturl()
    stem = Path(urlparse(final).path).stem or "downloaded_document"
    target = Path(directory) / (stem + suffix_for(kind, final))
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(body)
    return target, kind
