"""Training-data operators: near-duplicates, search, packing, filters, scans."""
