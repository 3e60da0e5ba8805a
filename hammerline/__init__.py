"""Market analytics on Spark: sales of lots at auctions, as DataFrame plans."""
