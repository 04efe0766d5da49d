"""Case tables, case catalogue, scenario parameters and the keyed report store."""
