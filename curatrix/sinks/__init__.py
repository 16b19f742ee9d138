"""Writers: CSV, id lists, labels, COCO documents, JSON reports, staged and versioned folders."""
