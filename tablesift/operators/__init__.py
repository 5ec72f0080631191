"""Set-based operators over long cell, token, geometry and page frames."""
