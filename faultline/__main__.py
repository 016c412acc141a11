import sys

from faultline.cli import main

sys.exit(main())
