"""Tables, serving queries and jobs composed from the operators."""
