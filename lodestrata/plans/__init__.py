"""Layer plans: bronze, silver, mapping, gold, dashboards and the whole run."""
