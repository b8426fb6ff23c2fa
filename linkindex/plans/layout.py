"""Where the jobs find and leave their files."""

from __future__ import annotations

from dataclasses import dataclass, field

from linkindex.schemas import CH, LINKS, PAYE, TCN, VAT

INDEX_FILE = "INDEX"


@dataclass(frozen=True)
class Layout:
    """Folders and file names below ``home``; every part can be given."""

    home: str
    external: str = "external"
    work: str = "working"
    previous: str = "previous"
    extracts: str = "extracts"
    published: str = "published"
    history: str = "history/index"
    new_links_file: str = "new_links/legal_units.parquet"
    inputs: dict[str, str] = field(
        default_factory=lambda: {
            CH: "company/*.csv",
            VAT: "vat/*.csv",
            PAYE: "paye/*.csv",
            TCN: "lookups/tcn-to-sic.csv",
        }
    )
    files: dict[str, str] = field(
        default_factory=lambda: {
            CH: "company.parquet",
            VAT: "vat.parquet",
            PAYE: "paye.parquet",
            TCN: "tcn.parquet",
            LINKS: "links.parquet",
            INDEX_FILE: "index.parquet",
        }
    )

    def admin_input(self, src: str) -> str:
        return f"{self.home}/{self.external}/{self.inputs[src]}"

    def working(self, src: str) -> str:
        return f"{self.work_dir}/{self.files[src]}"

    @property
    def work_dir(self) -> str:
        return f"{self.home}/{self.work}"

    @property
    def prev_dir(self) -> str:
        return f"{self.home}/{self.previous}"

    @property
    def prev_links(self) -> str:
        return f"{self.prev_dir}/{self.files[LINKS]}"

    @property
    def new_links(self) -> str:
        return f"{self.home}/{self.new_links_file}"

    @property
    def index(self) -> str:
        return self.working(INDEX_FILE)

    @property
    def publish_dir(self) -> str:
        return f"{self.home}/{self.published}"

    @property
    def history_path(self) -> str:
        return f"{self.home}/{self.history}"

    def extract(self, name: str) -> str:
        return f"{self.work_dir}/{self.extracts}/{name}.csv"
