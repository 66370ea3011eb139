"""One function per source: raw history frame in, clean frame out.

Clean frames keep the source's own columns next to the canonical ones; ``common.listings`` projects them.
"""

from . import americas, asia_pacific, europe, final

# Source name -> normaliser of that source alone.  Sources that are combined (United States, Japan, China) have a
# function of their own in ``COMBINED``, which takes the raw frames by source name.
SINGLE = {
    "Euronext": europe.euronext,
    "AAStocks": asia_pacific.aastocks,
    "TMX": americas.tmx,
    "Frankfurt": europe.frankfurt,
    "KRX": asia_pacific.krx,
    "ASX": asia_pacific.asx,
    "TWSE": asia_pacific.twse,
    "BME": europe.bme,
    "SGX": asia_pacific.sgx,
    "IDX": asia_pacific.idx,
    "BM": asia_pacific.bursa_malaysia,
    "NasdaqNordic": europe.nasdaq_nordic,
    "SpotlightAPI": europe.spotlight,
    "BIT": europe.borsa_italiana,
    "IPOHub": europe.ipohub,
}
# Defined, but not part of the standing set.
OPTIONAL = {"LSE": europe.lse, "NSE": asia_pacific.nse}
COMBINED = {
    "United States": americas.united_states,
    "Japan": asia_pacific.japan,
    "China": asia_pacific.china,
}
combine_all = final.combine_all
