"""Ready-made compositions of operators: layers, views, dashboards, layouts."""
