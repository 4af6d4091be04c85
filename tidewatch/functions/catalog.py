"""Feature catalogue: named groups of metric columns.

The catalogue drives projection, numeric casting, zero-as-missing handling
and unpivoting.  Any group can be handed to those operators.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: telemetry column names of the source logs -------------
SIGNAL_QUALITY = ["4GRSRP", "4GRSRQ", "SNR", "4GSignal", "BRSRP", "RSRQ", "5GSNR", "CQI"]
THROUGHPUT = [
    "LTEPDSCHPeakThroughput", "LTEPDSCHThroughput",
    "LTEPUSCHPeakThroughput", "LTEPUSCHThroughput",
    "5GNRPDSCHThroughput", "5GNRPUSCHThroughput",
    "5GNRPDSCHPeakThroughput", "5GNRPUSCHPeakThroughput",
    "5GNRRxPDCPBytes", "5GNRPxTxPDCPBytes",
]
COUNTERS = ["TxPDCPBytes", "RxPDCPBytes", "TotalBytesReceived", "TotalBytesSent",
            "TotalPacketReceived", "TotalPacketSent"]
ZERO_IS_MISSING = ["RSRQ", "4GRSRQ", "4GRSRP", "BRSRP"]
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class FeatureCatalog:
    groups: dict = field(default_factory=lambda: {
        "signal_quality": list(SIGNAL_QUALITY),
        "throughput_data": list(THROUGHPUT),
        "counters": list(COUNTERS),
    })
    zero_is_missing: tuple = tuple(ZERO_IS_MISSING)
    entity: str = "sn"
    time: str = "time"
    id_columns: tuple = ("MDN",)

    def features(self, *names: str) -> list[str]:
        names = names or tuple(self.groups)
        out: list[str] = []
        for n in names:
            for c in self.groups[n]:
                if c not in out:
                    out.append(c)
        return out


DEFAULT_CATALOG = FeatureCatalog()
