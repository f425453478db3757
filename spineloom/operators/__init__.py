"""DataFrame operators: null handling, category maps, fused entity features, quality reports."""
