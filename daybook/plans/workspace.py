"""Where the jobs find and leave their data below one root folder."""

from dataclasses import dataclass

from daybook.schemas import INCOMING, PRODUCTS


@dataclass(frozen=True)
class Workspace:
    root: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name.strip('/')}"

    def incoming(self, file_type: str) -> str:
        return self._at(INCOMING + file_type)

    @property
    def products(self) -> str:
        return self._at(PRODUCTS)

    def clean(self, file_type: str) -> str:
        """Typed rows of valid files, stored by day of the gate run, run and month."""
        return self._at(f"validated/{file_type}")

    @property
    def clean_flat(self) -> str:
        """Typed rows of flat files without a broken row."""
        return self._at("cleaned")

    @property
    def manifests(self) -> str:
        return self._at("validated/manifests")

    @property
    def gate_log(self) -> str:
        """One row per judged file; a run is committed by its rows here."""
        return self._at("gate_log")

    @property
    def archive(self) -> str:
        """Raw lines of judged files, by type, verdict, day and run."""
        return self._at("archive")

    @property
    def ledger(self) -> str:
        return self._at("ledger")

    @property
    def category_kpis(self) -> str:
        return self._at("kpis/category_daily")

    @property
    def order_kpis(self) -> str:
        return self._at("kpis/order_daily")

    @property
    def flat_category_kpis(self) -> str:
        """KPIs of the flat variant, apart from those of orders and items."""
        return self._at("kpis/flat_category_daily")

    @property
    def flat_order_kpis(self) -> str:
        return self._at("kpis/flat_order_daily")

    @property
    def rejected_rows(self) -> str:
        """Text rows of rejected flat files, each with the rules it breaks."""
        return self._at("rejected_rows")

    def part(self, name: str) -> str:
        """Partial sums of processed rows, see `operators/parts.py`."""
        return self._at(f"parts/{name}")

    def staging(self, run_id: str) -> str:
        return self._at(f"staging/{run_id}")
