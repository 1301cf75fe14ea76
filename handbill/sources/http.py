"""A page source over HTTP: one partition per url, a null body where the request fails. ``spark.dataSource.register(PageSource)``,
then ``spark.read.format("pages_http").option("urls", "\\n".join(urls)).load()``. Rendering and reader services plug in as ``fetch``."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed values of a request.
TIMEOUT, AGENT = 20, "Mozilla/5.0 (compatible; listings)"


def fetch(url: str, timeout: int = TIMEOUT) -> str | None:
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, headers={"User-Agent": AGENT}), timeout=timeout) as r:  # noqa: S310
            return r.read().decode(r.headers.get_content_charset() or "utf-8", "ignore")
    except (OSError, ValueError):
        return None


class _Url(InputPartition):
    def __init__(self, url: str):
        super().__init__(url)


class PageReader(DataSourceReader):
    def __init__(self, urls: list[str], get: Callable[[str], str | None]):
        self.urls, self.get = urls, get

    def partitions(self) -> list[InputPartition]:
        return [_Url(u) for u in self.urls]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield partition.value, self.get(partition.value)


class PageSource(DataSource):
    get = staticmethod(fetch)

    @classmethod
    def name(cls) -> str:
        return "pages_http"

    def schema(self) -> str:
        return "source_url string, html string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader([u for u in self.options.get("urls", "").split("\n") if u], type(self).get)
