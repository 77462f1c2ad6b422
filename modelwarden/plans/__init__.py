"""Rule catalogues and the reports assembled from the operators."""
