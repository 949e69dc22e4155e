"""One module of registered queries per operator."""
