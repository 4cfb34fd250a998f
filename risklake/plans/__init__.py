"""Named datasets: cleaned tables, risk views, loan-book operators, the refresh of all layers."""
