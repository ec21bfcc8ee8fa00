"""DataFrame-in, DataFrame-out ledger operators."""
