"""The twenty metric jobs, the fused panel run, the catalogue and the
registered operator queries."""
