"""DataFrame to DataFrame builders; none of them collects a corpus."""
