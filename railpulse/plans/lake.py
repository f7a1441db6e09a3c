"""Where the tables of a deployment lie."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    """Table roots under one folder, in one format."""

    root: str
    format: str = "parquet"

    def _at(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    @property
    def bronze_arrivals(self) -> str:
        return self._at("bronze", "arrivals")

    @property
    def silver_arrivals(self) -> str:
        return self._at("silver", "arrivals")

    @property
    def arrival_metrics(self) -> str:
        return self._at("gold", "arrival_metrics_15m")

    @property
    def arrival_events(self) -> str:
        return self._at("gold", "arrival_events")

    @property
    def station_kpi(self) -> str:
        return self._at("gold", "station_daily_kpi")

    @property
    def bronze_usage(self) -> str:
        return self._at("bronze", "usage")

    @property
    def silver_usage(self) -> str:
        return self._at("silver", "usage")

    @property
    def station_usage(self) -> str:
        return self._at("gold", "usage_station_daily")

    @property
    def line_usage(self) -> str:
        return self._at("gold", "usage_line_daily")

    @property
    def report_context(self) -> str:
        return self._at("report", "context")
