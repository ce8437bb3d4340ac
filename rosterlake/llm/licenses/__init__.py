"""Full texts of licenses, as the systems that carry them print them."""
