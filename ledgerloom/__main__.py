from ledgerloom.plans.cli import main

raise SystemExit(main())
