"""Category jobs, test stand-ins and the registered queries."""
