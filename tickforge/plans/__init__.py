"""Plans: the silver/gold pipeline and the catalogue of registered queries."""
